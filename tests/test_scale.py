"""Plans and skew: what reaches the scan, what is shuffled, what a hot group does."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from martflow.operators import (
    DAILY_CATEGORY_MART,
    affected_days,
    build_mart,
    column_checks,
    current_rows,
    latest_per_key,
    lookup,
    one_row_per_key,
    rows_after,
    touched_days,
    valid_rows,
)
from martflow.plans import publish, scratch, written
from workloads.queries import CURSOR, QUERIES, _clean
from workloads.tables import DAILY_COUNTRY_MART, EVENT_ORDERS, LINES, event_orders, lines

FOLDER = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def finished_plan(df) -> str:
    df.collect()
    return plan(df)


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tiny_partitions(spark):
    """Make a few kilobytes count as a skewed partition, and broadcast nothing."""
    return settings(
        spark,
        spark__sql__shuffle__partitions="40",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )


def hot_orders(spark, n=60_000):
    """A third of all rows belongs to one key, one customer and one day."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 6).select(
        F.when(hot, F.lit(-1)).otherwise(F.col("id")).alias("order_id"),
        F.when(hot, F.lit(-1)).otherwise(F.col("id") % 997).alias("customer_id"),
        F.timestamp_add("SECOND", F.when(hot, F.col("id") % 86_400).otherwise((F.col("id") * 97) % 864_000).cast("int"),
                        F.lit("2025-02-01 00:00:00").cast("timestamp_ntz")).alias("order_ts"),
        F.lit("books").alias("category"),
        F.lit(1).alias("quantity"),
        F.lit(1.0).alias("unit_price"),
    ).withColumn("order_date", F.to_date("order_ts"))


WRITING = {
    "append_batches", "clean_layer_roundtrip", "csv_contract", "dynamic_overwrite", "emptied_days",
    "first_load", "full_refresh_rebuild", "incremental_equals_full", "incremental_mart",
    "customers_contract", "gate_stops_run", "latest_across_batches", "ledger_last_run", "ledger_runs", "ledger_volumes", "ledger_watermark", "lookback_runs",
    "malformed_lines", "merged_batches", "refresh_to_empty",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_query_needs_python_rows_or_pairs(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in text


def test_the_cursor_and_the_rules_reach_the_parquet_scan(spark):
    new = rows_after(event_orders(spark, FOLDER), CURSOR, "order_ts")
    with settings(spark, spark__sql__maxMetadataStringLength="10000"):
        text = plan(valid_rows(new, EVENT_ORDERS.rules).select("order_id"))
    assert "GreaterThan(ts,2024-01-15T00:00)" in text
    assert "GreaterThan(value,0.0)" in text
    assert "event_type" not in text


def test_the_mart_reads_only_its_columns_and_expands_no_rows(spark):
    rows = lines(spark, FOLDER)
    assert "l_tax" not in plan(rows) and "l_discount" not in plan(rows)
    text = plan(build_mart(_clean(spark, FOLDER), DAILY_CATEGORY_MART, EVENT_ORDERS.key))
    assert "Expand" not in text
    assert "Expand" in plan(build_mart(_clean(spark, FOLDER), DAILY_CATEGORY_MART))


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = hot_orders(spark)
    latest = latest_per_key(df, ["order_id"], "order_ts")
    text = plan(latest)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert latest.count() == 40_001


def test_a_hot_customer_is_split_in_a_shuffled_lookup(spark, tmp_path):
    df = hot_orders(spark)
    dims = df.select("customer_id").withColumn("country", F.lit("PT"))
    people = written(one_row_per_key(dims, "customer_id", ["country"]), str(tmp_path / "people"))
    with tiny_partitions(spark):
        joined = lookup(df, people, "customer_id", "customer_id", ["country"], reduced=True)
        assert "skew=true" in finished_plan(joined)
        assert joined.filter("country = 'PT'").count() == df.count()


def test_a_hot_customer_is_one_row_per_group_when_a_mart_looks_it_up(spark):
    dims = hot_orders(spark).select("customer_id").distinct().withColumn("country", F.lit("PT"))
    with tiny_partitions(spark):
        text = plan(build_mart(hot_orders(spark), DAILY_COUNTRY_MART, EVENT_ORDERS.key, dims))
    join = text.index("SortMergeJoin")
    assert text.index("partial_sum", join) > join  # facts are aggregated below the join


def test_a_hot_key_is_split_when_affected_days_are_sought(spark, tmp_path):
    history = written(hot_orders(spark), str(tmp_path / "history"))
    some = history.filter("order_id % 50 = 2 OR order_id = -1").dropDuplicates(["order_id"])
    batch = written(some, str(tmp_path / "batch"))
    with tiny_partitions(spark):
        days = affected_days(batch, history, EVENT_ORDERS)
        assert "skew=true" in finished_plan(days)
        assert days.count() == touched_days(history, "order_date").count()


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB"):
        publish.write_batch(hot_orders(spark), str(tmp_path / "clean"), 1, 1, EVENT_ORDERS)
    root = tmp_path / "clean/epoch=1/batch_id=1"
    files = {d.name: len(list(d.glob("*.parquet"))) for d in root.iterdir() if d.is_dir()}
    assert len(files) == 10
    assert files["order_date=2025-02-01"] > 2
    assert publish.read_batches(spark, str(tmp_path / "clean"), 1, 1, EVENT_ORDERS).count() == 60_000


def test_a_write_counts_its_rows_behind_the_last_shuffle(spark, tmp_path):
    counts = {"rows": F.count(F.lit(1)), "none": F.count_if(F.col("order_id").isNull())}
    rows = hot_orders(spark)
    wanted = (str(tmp_path / "clean"), 1, 1, EVENT_ORDERS)
    with tiny_partitions(spark):
        assert publish.write_batch(rows, *wanted, counts) == {"rows": rows.count(), "none": 0}
        assert publish.write_batch(rows.limit(0), *wanted, counts) == {"rows": 0, "none": 0}


def test_a_uniqueness_check_is_one_scan_and_one_shuffle_of_its_column(spark):
    shown = plan(column_checks(hot_orders(spark), unique=("order_id",)))
    assert shown.count("hashpartitioning") == 1 and shown.count("Scan") <= 2  # the data, and one made-up row


def test_a_rebuild_reads_no_partition_before_its_first_day(spark, tmp_path):
    publish.write_batch(hot_orders(spark), str(tmp_path / "clean"), 1, 1, EVENT_ORDERS)
    history = publish.read_batches(spark, str(tmp_path / "clean"), 1, 1, EVENT_ORDERS).drop("batch_id")
    day = dt.date(2025, 2, 8)
    days = written(
        history.select("order_date").distinct().filter(F.col("order_date") == F.lit(day)), str(tmp_path / "days")
    )
    again = publish.read_batch(spark, str(tmp_path / "clean"), 1, 1, EVENT_ORDERS)
    assert again.count() == history.count() == 60_000
    text = plan(current_rows(history, days, day, EVENT_ORDERS))
    assert "order_date#" in text and ">= 2025-02-08" in text
    assert "dynamicpruning" in text


def test_scratch_folder_follows_the_session(spark):
    root = spark.conf.get(scratch.CHECKPOINT_SETTING)
    one, two = scratch.scratch_folder(spark), scratch.scratch_folder(spark)
    assert one.startswith(root) and two.startswith(root) and one != two


def test_without_a_checkpoint_folder_scratch_lies_in_the_warehouse():
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "hdfs:/wh/"}.get(key, default))})

    assert scratch.scratch_folder(Session).startswith("hdfs:/wh/_scratch/martflow-")


def test_composite_keys_keep_every_version_apart(spark):
    rows = lines(spark, FOLDER)
    latest = latest_per_key(rows, LINES.key, LINES.time, LINES.tiebreak)
    assert latest.count() == rows.select(*LINES.key).distinct().count()


def test_brand_mart_meets_orders_in_bounded_tasks(spark, tmp_path, monkeypatch):
    from workloads import queries

    spark.sql(
        "SELECT id DIV 3 AS l_orderkey, id % 50 AS l_partkey, 1.0D AS l_quantity, id / 4 AS l_extendedprice FROM range(3000)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql(
        "SELECT id AS o_orderkey, id % 90 AS o_custkey, timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id % 9 AS INT)) AS o_orderdate FROM range(1000)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS p_partkey, concat('brand ', id % 4) AS p_brand FROM range(50)").write.parquet(f"{tmp_path}/part.parquet")
    few = sorted(queries.brand_mart(spark, str(tmp_path)).collect())
    monkeypatch.setattr(queries, "LINES_AT_ONCE", 300)
    mart = queries.brand_mart(spark, str(tmp_path))
    assert sorted(mart.collect()) == few and len(few) == 36
    plan = mart._jdf.queryExecution().toString()
    assert "hashpartitioning(l_orderkey" in plan and ", 10), REPARTITION_BY_NUM" in plan
