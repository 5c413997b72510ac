"""One query per operator, each over whole tables.  Keys follow the survey's inventory."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martflow.functions import rounded
from martflow.operators import (
    DAILY_CATEGORY_MART,
    FAILED_RULES,
    BatchRejected,
    CheckPlan,
    CountDistinct,
    MartSpec,
    Money,
    Ratio,
    Reference,
    Sum,
    affected_days,
    batch_high,
    build_mart,
    column_checks,
    current_rows,
    days_of_keys,
    dimension_changes,
    latest_per_key,
    lookup,
    one_row_per_key,
    orphan_keys,
    parse_time,
    reference_check,
    rejected_rows,
    rows_after,
    rows_on_days,
    running_baseline,
    touched_days,
    valid_rows,
    volume_verdict,
    with_derived,
)
from martflow.plans import (
    RETAIL_CHECKS,
    Flow,
    FlowSpec,
    last_run,
    scratch_folder,
    stored_cursor,
    volume_history,
    written,
)
from martflow.plans.publish import read_mart, replace_days
from martflow.plans.sides import days_in, key_days
from martflow.sources import CUSTOMERS_SCHEMA, ORDERS, Rule, read_contract

from .tables import (
    DAILY_BRAND_MART,
    DAILY_COUNTRY_MART,
    EVENT_ORDERS,
    LINES,
    MONTHLY_FLAG_MART,
    customers,
    event_orders,
    lines,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Cut points of the multi-batch runs.  The last batch takes all that is left.
EVENT_CUTS = ("2024-01-08 12:00:00", "2024-01-16 00:00:00", "2024-01-23 12:00:00")
LINE_CUTS = ("1996-09-15 00:00:00", "1998-06-15 00:00:00", "2000-03-15 00:00:00")
CURSOR = "2024-01-15 00:00:00"
LINE_CURSOR = "2000-06-30 00:00:00"
LINES_AT_ONCE = 500_000


# -- frames that several queries share ---------------------------------------


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse_time(event_orders(spark, folder), EVENT_ORDERS)


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_rows(_parsed(spark, folder), EVENT_ORDERS.rules)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(
        _valid(spark, folder), EVENT_ORDERS.key, EVENT_ORDERS.time, EVENT_ORDERS.ties
    )


def _valid_lines(spark: SparkSession, folder: str) -> DataFrame:
    return valid_rows(parse_time(lines(spark, folder), LINES), LINES.rules)


def _daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).groupBy("order_date").agg(F.count(F.lit(1)).alias("rows_in_batch"))


# -- flows ---------------------------------------------------------------------


def _run_flow(
    spark: SparkSession, source: Callable[[SparkSession], DataFrame], time: str, cuts, **spec
) -> Flow:
    """Run a flow once per cut point, as if the source had grown to it, and once in full."""
    root = scratch_folder(spark)
    paths = dict(clean=f"{root}/clean", mart=f"{root}/mart", ledger=f"{root}/ledger")
    for cut in (*cuts, None):
        grown = lambda s, cut=cut: rows_after(source(s), None, time, upto=cut)
        flow = Flow(spark, FlowSpec(source=grown, **paths, **spec))
        flow.run()
    return flow


def _event_flow(spark: SparkSession, folder: str, cuts=EVENT_CUTS) -> Flow:
    return _run_flow(
        spark, lambda s: event_orders(s, folder), "order_ts", cuts,
        dimension=lambda s: customers(s, folder),
        contract=EVENT_ORDERS, mart_spec=DAILY_CATEGORY_MART, checks=RETAIL_CHECKS,
    )


def _line_flow(spark: SparkSession, folder: str, cuts=LINE_CUTS, **options) -> Flow:
    return _run_flow(
        spark, lambda s: lines(s, folder), "l_shipdate", cuts,
        contract=LINES, mart_spec=MONTHLY_FLAG_MART,
        checks=CheckPlan(not_null=LINES.key, unique=(LINES.key,), non_negative=("l_quantity",)), **options,
    )


# -- scans -----------------------------------------------------------------------


def scan_contract(spark: SparkSession, folder: str) -> DataFrame:
    return event_orders(spark, folder)


def csv_contract(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a CSV file with a header, read back against the text contract."""
    path = f"{scratch_folder(spark)}/orders"
    raw = event_orders(spark, folder).withColumn("order_ts", F.col("order_ts").cast("string"))
    raw.write.option("header", True).csv(path)
    return parse_time(read_contract(spark, path, ORDERS.schema, "csv", strict_header=True), ORDERS)


def clean_layer_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _event_flow(spark, folder, cuts=()).clean()


# -- projections and filters -------------------------------------------------------


def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Times as text, those of one category made unreadable."""
    text = F.col("order_ts").cast("string")
    broken = F.when(F.col("category") == "error", F.concat(F.lit("at "), text)).otherwise(text)
    raw = event_orders(spark, folder).withColumn("order_ts", broken)
    return parse_time(raw, EVENT_ORDERS).select("order_id", "order_ts", "order_date")


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    rows = rejected_rows(_parsed(spark, folder), EVENT_ORDERS.rules)
    return rows.withColumn(FAILED_RULES, F.array_join(FAILED_RULES, ","))


def select_new(spark: SparkSession, folder: str) -> DataFrame:
    return rows_after(event_orders(spark, folder), CURSOR, "order_ts")


def select_new_lookback(spark: SparkSession, folder: str) -> DataFrame:
    return rows_after(event_orders(spark, folder), CURSOR, "order_ts", lookback="36 hours")


def high_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return batch_high(event_orders(spark, folder), "order_ts")


def touched(spark: SparkSession, folder: str) -> DataFrame:
    return touched_days(rows_after(_parsed(spark, folder), CURSOR, "order_ts"), "order_date")


def touched_days_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rows on the days that hold the largest single values of a category."""
    best = _valid(spark, folder).groupBy("category").agg(
        F.max_by("order_date", F.struct("unit_price", "order_id")).alias("order_date")
    )
    return rows_on_days(_valid(spark, folder), best.select("order_date").distinct(), "order_date")


def affected(spark: SparkSession, folder: str) -> DataFrame:
    """Months a late batch of order lines touches, through corrections too."""
    rows = _valid_lines(spark, folder)
    late = rows_after(rows, LINE_CURSOR, "l_shipdate")
    batch = latest_per_key(late, LINES.key, LINES.time, LINES.ties)
    batch = written(batch, f"{scratch_folder(spark)}/batch")
    return affected_days(batch, rows_after(rows, None, "l_shipdate", upto=LINE_CURSOR), LINES)


def rebuild_affected(spark: SparkSession, folder: str) -> DataFrame:
    """Current order lines of the busiest month per return flag and year."""
    rows = _valid_lines(spark, folder)
    peaks = rows.groupBy("l_returnflag", F.year("ship_month").alias("y"), "ship_month").count()
    best = peaks.groupBy("l_returnflag", "y").agg(
        F.max_by("ship_month", F.struct("count", "ship_month")).alias("ship_month")
    )
    days = written(best.select("ship_month").distinct(), f"{scratch_folder(spark)}/months")
    return current_rows(rows, days, days.agg(F.min("ship_month")).first()[0], LINES)


def revenue_projection(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_derived(_valid(spark, folder), DAILY_CATEGORY_MART)
    return rows.select("order_id", rounded(F.col("revenue")).alias("revenue"))


# -- joins ---------------------------------------------------------------------------


def enrich_left(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_derived(_valid(spark, folder), DAILY_CATEGORY_MART)
    people = one_row_per_key(customers(spark, folder), "customer_id", ["country"])
    people = written(people, f"{scratch_folder(spark)}/people")
    joined = lookup(rows, people, "customer_id", "customer_id", ["country"], reduced=True)
    return joined.select(
        "order_id", "customer_id", rounded(F.col("revenue")).alias("revenue"), "country"
    )


def enrich_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Orders looked up in a table that repeats some keys and lacks others."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    brought = ["l_shipdate", "l_returnflag"]
    items = one_row_per_key(table(spark, folder, "lineitem"), "l_orderkey", brought)
    items = written(items, f"{scratch_folder(spark)}/items")
    return lookup(orders, items, "o_orderkey", "l_orderkey", brought, reduced=True)


def orphans_anti(spark: SparkSession, folder: str) -> DataFrame:
    orders, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return orphan_keys(orders, "o_orderkey", items, "l_orderkey")


# -- windows and sets ------------------------------------------------------------------


def latest_lines(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(_valid_lines(spark, folder), LINES.key, LINES.time, LINES.ties)


def latest_across_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _line_flow(spark, folder).current()


def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return lines(spark, folder).select(*LINES.key).distinct()


# -- marts -------------------------------------------------------------------------------


def daily_mart(spark: SparkSession, folder: str) -> DataFrame:
    clean = _clean(spark, folder)
    return build_mart(clean, DAILY_CATEGORY_MART, EVENT_ORDERS.key).orderBy("order_date", "category")


def country_mart(spark: SparkSession, folder: str) -> DataFrame:
    people = one_row_per_key(customers(spark, folder), "customer_id", ["country"])
    people = written(people, f"{scratch_folder(spark)}/people")
    return build_mart(_clean(spark, folder), DAILY_COUNTRY_MART, EVENT_ORDERS.key, people, reduced=True)


def brand_mart(spark: SparkSession, folder: str) -> DataFrame:
    """Lines meet their orders in tasks of ``LINES_AT_ONCE``, which then reduce them without a shuffle.

    Left to adaptive execution, tasks grow with the tables, and so do the aggregates they hold.
    """
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    tasks = -(-items.count() // LINES_AT_ONCE)
    facts = items.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if tasks > spark.sparkContext.defaultParallelism:
        facts, orders = facts.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    facts = facts.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return build_mart(facts.withColumn("order_date", F.to_date("o_orderdate")), DAILY_BRAND_MART)


# -- checks --------------------------------------------------------------------------------


def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_orders(spark, folder).withColumn("quantity", F.nullif("quantity", F.lit(0)))
    return column_checks(rows, not_null=["quantity", "order_id"])


def check_non_negative(spark: SparkSession, folder: str) -> DataFrame:
    return column_checks(
        table(spark, folder, "customer"), non_negative=["c_acctbal", "c_nationkey"]
    )


def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder).withColumn("l_quantity", F.nullif("l_quantity", F.lit(1.0)))
    return column_checks(rows, unique=[LINES.key, "l_quantity"])


def check_referential(spark: SparkSession, folder: str) -> DataFrame:
    orders, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return reference_check(orders, "o_orderkey", items, "l_orderkey").unionByName(
        reference_check(items, "l_orderkey", orders, "o_orderkey")
    )


def volume_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return running_baseline(_daily_counts(spark, folder), "order_date", "rows_in_batch")


def volume_anomaly_by_day(spark: SparkSession, folder: str) -> DataFrame:
    counts = running_baseline(_daily_counts(spark, folder), "order_date", "rows_in_batch", lookback=7)
    passed, detail = volume_verdict(
        F.col("rows_in_batch"), F.col("runs"), F.col("baseline"), tolerance=0.02
    )
    return counts.select(
        "order_date", "rows_in_batch", passed.alias("passed"), detail.alias("detail")
    )


def check_volume(spark: SparkSession, folder: str) -> DataFrame:
    """The newest day against all days before it."""
    counts = running_baseline(_daily_counts(spark, folder), "order_date", "rows_in_batch")
    passed, detail = volume_verdict(F.col("rows_in_batch"), F.col("runs"), F.col("baseline"))
    newest = counts.orderBy(F.desc("order_date")).limit(1)
    return newest.select(
        F.lit("volume_anomaly").alias("name"), passed.alias("passed"), detail.alias("detail")
    )


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder).withColumn("gain", F.col("l_extendedprice") - 1000)
    checks = column_checks(
        rows, not_null=["l_orderkey"], unique=[LINES.key], non_negative=["gain"]
    )
    orders = table(spark, folder, "orders")
    return checks.unionByName(
        reference_check(orders, "o_orderkey", rows, "l_orderkey")
    ).unionByName(check_volume(spark, folder))


# -- sinks, ledger and whole flows ------------------------------------------------------------


def first_load(spark: SparkSession, folder: str) -> DataFrame:
    flow = _event_flow(spark, folder, cuts=())
    return flow.versions().groupBy("batch_id", "order_date").agg(F.count(F.lit(1)).alias("n"))


def append_batches(spark: SparkSession, folder: str) -> DataFrame:
    flow = _event_flow(spark, folder)
    return flow.versions().groupBy("batch_id", "order_date").agg(F.count(F.lit(1)).alias("n"))


def merged_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The fact layer after four batches have been merged into one folder."""
    flow = _event_flow(spark, folder)
    flow.compact()
    return flow.versions().groupBy("batch_id", "order_date").agg(F.count(F.lit(1)).alias("n"))


def incremental_mart(spark: SparkSession, folder: str) -> DataFrame:
    return _line_flow(spark, folder).mart()


def full_refresh_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    flow = _event_flow(spark, folder)
    flow.run(full_refresh=True)
    return flow.mart()


def dynamic_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A published mart whose Mondays are then replaced by negated units."""
    root = scratch_folder(spark)
    mart = written(daily_mart(spark, folder), f"{root}/fresh")
    replace_days(mart, None, f"{root}/mart", "order_date", ["category"])
    mondays = written(
        mart.filter(F.weekday("order_date") == 0).withColumn("units", -F.col("units")),
        f"{root}/mondays",
    )
    days = [r[0] for r in touched_days(mondays, "order_date").collect()]
    replace_days(mondays, days, f"{root}/mart", "order_date", [])
    return read_mart(spark, f"{root}/mart", mart.schema)


def emptied_days(spark: SparkSession, folder: str) -> DataFrame:
    """A published mart whose Mondays lose all their rows."""
    root = scratch_folder(spark)
    mart = written(daily_mart(spark, folder), f"{root}/fresh")
    replace_days(mart, None, f"{root}/mart", "order_date", ["category"])
    mondays = mart.filter(F.weekday("order_date") == 0)
    days = [r[0] for r in touched_days(mondays, "order_date").collect()]
    replace_days(mart.limit(0), days, f"{root}/mart", "order_date", [])
    return read_mart(spark, f"{root}/mart", mart.schema)


def incremental_equals_full(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of the mart built in batches, and how many differ from one full build."""
    batches = _line_flow(spark, folder).mart()
    once = _line_flow(spark, folder, cuts=()).mart()
    differing = batches.exceptAll(once).union(once.exceptAll(batches))
    counted = batches.select(F.lit(1).alias("g"), F.lit(0).alias("d")).union(
        differing.select(F.lit(0), F.lit(1))
    )
    return counted.agg(F.sum("g").alias("mart_groups"), F.sum("d").alias("differing_groups"))


def ledger_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return stored_cursor(_event_flow(spark, folder).ledger())


def ledger_volumes(spark: SparkSession, folder: str) -> DataFrame:
    return volume_history(_event_flow(spark, folder).ledger())


def ledger_last_run(spark: SparkSession, folder: str) -> DataFrame:
    """The last of five runs; it found nothing new."""
    flow = _event_flow(spark, folder)
    flow.run()
    return last_run(flow.ledger()).select(
        "run_seq", "status", "mode", "rows_read", "rows_in_batch", "watermark_before",
        "watermark_after", F.size("checks").cast("bigint").alias("n_checks"),
    )


def ledger_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every successful run with its check outcomes."""
    return (
        _event_flow(spark, folder).ledger().filter("status = 'success'")
        .select("run_seq", "rows_read", "rows_rejected", "watermark_after", F.explode("checks").alias("c"))
        .select("run_seq", "rows_read", "rows_rejected", "watermark_after", "c.name", "c.passed")
    )


# -- amounts, ratios and unusual runs ------------------------------------------------------------


def large_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Line prices a thousand million times as high, in valid rows, summed."""
    rows = _valid_lines(spark, folder).withColumn("l_extendedprice", F.col("l_extendedprice") * 1e9)
    spec = MartSpec(
        "ship_month", ("l_returnflag",),
        (Money("total_revenue", "l_extendedprice"), CountDistinct("orders", "l_orderkey")),
    )
    return build_mart(valid_rows(rows, LINES.rules), spec)


def ratio_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Ratios of every kind, by a grain that is null for some rows, over a zero divisor too."""
    rows = table(spark, folder, "lineitem").select(
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        "l_orderkey",
        "l_extendedprice",
        F.floor("l_extendedprice").cast("double").alias("whole"),
        F.col("l_quantity").cast("int").alias("pieces"),
        F.lit(0).alias("nothing"),
    )
    spec = MartSpec(
        "flag", ("flag",),
        (
            Money("revenue", "l_extendedprice"), Money("whole_revenue", "whole"),
            CountDistinct("orders", "l_orderkey"), Sum("pieces", "pieces"), Sum("nothing", "nothing"),
            Ratio("per_order", "revenue", "orders"), Ratio("share", "whole_revenue", "revenue", 6),
            Ratio("pieces_per_order", "pieces", "orders", 3), Ratio("per_nothing", "revenue", "nothing"),
        ),
    )
    return build_mart(rows, spec)


def customers_contract(spark: SparkSession, folder: str) -> DataFrame:
    """The customers as a file of two columns, read against the contract of three."""
    path = f"{scratch_folder(spark)}/customers"
    customers(spark, folder).write.option("header", True).csv(path)
    return read_contract(spark, path, CUSTOMERS_SCHEMA, optional=("signup_date",))


def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a file in which one category has words for quantities: what the text was."""
    path = f"{scratch_folder(spark)}/orders"
    words = F.when(F.col("category") == "error", F.concat(F.lit("about "), "quantity"))
    raw = event_orders(spark, folder).withColumns({
        "order_ts": F.col("order_ts").cast("string"),
        "quantity": F.coalesce(words, F.col("quantity").cast("string")),
    })
    raw.write.option("header", True).csv(path)
    rows = read_contract(spark, path, ORDERS.schema, malformed="line")
    return rows.select(
        "order_id", "category", "quantity", F.split_part("line", F.lit(","), F.lit(5)).alias("quantity_text")
    )


def gate_stops_run(spark: SparkSession, folder: str) -> DataFrame:
    """A second batch of lines whose orders are missing: what the failed run leaves."""
    root, cut = scratch_folder(spark), LINE_CUTS[0]
    known = rows_after(lines(spark, folder), None, "l_shipdate", upto=cut).select("l_orderkey")

    def flow(upto: str | None) -> Flow:
        return Flow(spark, FlowSpec(
            source=lambda s: rows_after(lines(s, folder), None, "l_shipdate", upto=upto),
            clean=f"{root}/clean", mart=f"{root}/mart", ledger=f"{root}/ledger",
            contract=LINES, mart_spec=MONTHLY_FLAG_MART, dimension=lambda s: known,
            checks=CheckPlan(reference=Reference("l_orderkey", "l_orderkey")),
        ))

    flow(cut).run()
    failures = []
    try:
        flow(None).run()
    except BatchRejected as stopped:
        failures = [f"{c.name}: {c.detail}" for c in stopped.failures]
    done = flow(None)
    finished = done.ledger().filter("status = 'success'").agg(F.count(F.lit(1)).alias("runs"))
    groups = done.mart().agg(F.count(F.lit(1)).alias("mart_groups"), F.sum("orders").alias("orders"))
    return finished.select(
        "runs",
        F.lit("; ".join(failures)).alias("failures"),
        done.clean().agg(F.count(F.lit(1))).scalar().alias("clean_rows"),
        groups.select("mart_groups").scalar().alias("mart_groups"),
        groups.select("orders").scalar().alias("orders"),
    )


def refresh_to_empty(spark: SparkSession, folder: str) -> DataFrame:
    """A mart, and then a refresh over a source that has lost all its rows."""
    flow = _event_flow(spark, folder, cuts=())
    emptied = replace(flow.spec, source=lambda s: event_orders(s, folder).limit(0))
    Flow(spark, emptied).run(full_refresh=True)
    left = flow.mart().agg(F.count(F.lit(1))).scalar()
    return flow.ledger().filter("status = 'success'").select(
        "run_seq", "mode", "rows_in_batch", "watermark_after", left.alias("mart_groups")
    )


def lookback_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs over an unchanged source, and a fourth to which late rows have come."""
    root = scratch_folder(spark)
    rows = event_orders(spark, folder)
    newest = rows.agg(F.max("order_ts")).scalar()
    near = (F.col("order_ts") > newest - F.expr("INTERVAL 36 HOURS")) & (F.col("order_ts") < newest)
    late = near & (F.col("order_id") % 50 == 7)
    for source in [rows.filter(~late)] * 3 + [rows]:
        flow = Flow(spark, FlowSpec(
            source=lambda s, source=source: source,
            clean=f"{root}/clean", mart=f"{root}/mart", ledger=f"{root}/ledger", lookback="2 days",
            contract=EVENT_ORDERS, mart_spec=DAILY_CATEGORY_MART, checks=CheckPlan(),
        ))
        flow.run()
    finished = flow.ledger().filter("status <> 'publishing'")
    return finished.select("run_seq", "status", "rows_read", "rows_in_batch", "watermark_after")


# -- changes that reach published days --------------------------------------------------------


def _moved(spark: SparkSession, folder: str, time: int) -> DataFrame:
    """The customers at a time: every fifth has moved, another fifth each time; some are not there yet."""
    people = table(spark, folder, "customer")
    moved = F.when(F.col("c_custkey") % 5 < time, (F.col("c_nationkey") + time) % 25)
    known = people.filter((F.col("c_custkey") % 11 != 3) | F.lit(time > 1)).select(
        F.col("c_custkey").alias("customer_id"), F.coalesce(moved, "c_nationkey").alias("place")
    )
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return known.join(nation, F.col("place") == F.col("n_nationkey"), "left").select("customer_id", "country")


def _country_flow(spark: SparkSession, folder: str, **options) -> Flow:
    """Three runs with new orders and other customers each time, and one where only customers moved."""
    root = scratch_folder(spark)
    for time, cut in enumerate((*EVENT_CUTS[:2], None, None)):
        flow = Flow(spark, FlowSpec(
            source=lambda s, cut=cut: rows_after(event_orders(s, folder), None, "order_ts", upto=cut),
            dimension=lambda s, time=time: _moved(s, folder, time),
            clean=f"{root}/clean", mart=f"{root}/mart", ledger=f"{root}/ledger",
            contract=EVENT_ORDERS, mart_spec=DAILY_COUNTRY_MART, checks=CheckPlan(), **options,
        ))
        flow.run()
    return flow


def dimension_change(spark: SparkSession, folder: str) -> DataFrame:
    """The mart by country after customers have moved between runs, and once without new orders."""
    return _country_flow(spark, folder, key_buckets=16).mart()


def dimension_runs(spark: SparkSession, folder: str) -> DataFrame:
    """What the ledger says of these runs, without an index."""
    runs = _country_flow(spark, folder).ledger().filter("status <> 'publishing'")
    return runs.select("run_seq", "status", "rows_in_batch", "watermark_after")


def changed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days with orders of customers who have moved, come or gone between two times."""
    states = [_moved(spark, folder, time) for time in (1, 2)]
    moved = dimension_changes(*states, "customer_id", ["country"])
    moved = written(moved, f"{scratch_folder(spark)}/moved")
    return days_of_keys(_valid(spark, folder), "customer_id", moved, "customer_id", "order_date")


def indexed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Months of the late lines and of the earlier versions of their keys, from the key index."""
    root = scratch_folder(spark)
    rows = _valid_lines(spark, folder)
    late = rows.filter(F.col("l_shipdate") > LINE_CURSOR)
    batch = written(latest_per_key(late, LINES.key, LINES.time, LINES.ties), f"{root}/batch")
    history = rows.filter(F.col("l_shipdate") <= LINE_CURSOR).select(*LINES.key, LINES.day).distinct()
    index = key_days(spark, f"{root}/clean", "key_days", LINES.clean_schema, LINES.key, LINES.day, 64)
    index.add(history, 1, 1)
    earlier = days_in(index, batch.select(*LINES.key), LINES.day, 1, 1)
    return touched_days(batch, LINES.day).union(earlier).distinct()


def delta_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly mart after four batches, kept up to date by differences."""
    return _line_flow(spark, folder, key_buckets=16, differences=True).mart()


def replayed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The daily mart of flows that first refused large orders, after these have been replayed, twice."""
    strict = replace(EVENT_ORDERS, rules=(*EVENT_ORDERS.rules, Rule("order_small", "quantity * unit_price < 100")))
    flow = _run_flow(
        spark, lambda s: event_orders(s, folder), "order_ts", EVENT_CUTS,
        contract=strict, mart_spec=DAILY_CATEGORY_MART, checks=CheckPlan(),
        rejects=f"{scratch_folder(spark)}/rejects",
    )
    flow = Flow(spark, replace(flow.spec, contract=EVENT_ORDERS))
    flow.replay()
    flow.replay()
    return flow.mart()


def _sliced(spark: SparkSession, folder: str, source, **spec) -> Flow:
    """A first load in about five slices that ends after two, and a second run that goes on."""
    root = scratch_folder(spark)
    flow = Flow(spark, FlowSpec(
        source=lambda s: source(s, folder), slice_rows=max(1, source(spark, folder).count() // 5),
        clean=f"{root}/clean", mart=f"{root}/mart", ledger=f"{root}/ledger", **spec,
    ))
    flow.run(most_slices=2)
    flow.run()
    return flow


def resumed_load(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly mart after a load in slices; versions of a line lie in different ones."""
    checks = CheckPlan(not_null=LINES.key, unique=(LINES.key,), non_negative=("l_quantity",))
    return _sliced(spark, folder, lines, contract=LINES, mart_spec=MONTHLY_FLAG_MART, checks=checks).mart()


def load_slices(spark: SparkSession, folder: str) -> DataFrame:
    """What the ledger says of such a load's slices, and of all of it."""
    flow = _sliced(
        spark, folder, event_orders, dimension=lambda s: customers(s, folder),
        contract=EVENT_ORDERS, mart_spec=DAILY_CATEGORY_MART, checks=RETAIL_CHECKS,
    )
    return flow.ledger().filter("status IN ('staged', 'success')").select(
        "status", "batch_id", "rows_read", "rows_rejected", "rows_in_batch", "watermark_after",
        F.count_if(F.col("status") == "staged").over(Window.partitionBy("run_seq")).alias("slices"),
    )


QUERIES: dict[str, Query] = {
    "daily_mart": daily_mart,
    "scan_contract": scan_contract,
    "csv_contract": csv_contract,
    "parse_timestamps": parse_timestamps,
    "valid_rows": _valid,
    "rejected_rows": rejected,
    "latest_per_key": latest_lines,
    "select_new": select_new,
    "select_new_lookback": select_new_lookback,
    "high_watermark": high_watermark,
    "touched_days": touched,
    "touched_days_filter": touched_days_filter,
    "affected_days": affected,
    "rebuild_affected": rebuild_affected,
    "revenue_projection": revenue_projection,
    "enrich_left": enrich_left,
    "enrich_unmatched": enrich_unmatched,
    "orphans_anti": orphans_anti,
    "distinct_keys": distinct_keys,
    "country_mart": country_mart,
    "brand_mart": brand_mart,
    "check_not_null": check_not_null,
    "check_non_negative": check_non_negative,
    "check_unique": check_unique,
    "check_referential": check_referential,
    "volume_baseline": volume_baseline,
    "check_volume": check_volume,
    "volume_anomaly_by_day": volume_anomaly_by_day,
    "quality_report": quality_report,
    "first_load": first_load,
    "append_batches": append_batches,
    "clean_layer_roundtrip": clean_layer_roundtrip,
    "dynamic_overwrite": dynamic_overwrite,
    "emptied_days": emptied_days,
    "full_refresh_rebuild": full_refresh_rebuild,
    "ledger_watermark": ledger_watermark,
    "ledger_volumes": ledger_volumes,
    "ledger_last_run": ledger_last_run,
    "ledger_runs": ledger_runs,
    "latest_across_batches": latest_across_batches,
    "incremental_mart": incremental_mart,
    "incremental_equals_full": incremental_equals_full,
    "large_amounts": large_amounts,
    "ratio_measures": ratio_measures,
    "customers_contract": customers_contract,
    "malformed_lines": malformed_lines,
    "gate_stops_run": gate_stops_run,
    "refresh_to_empty": refresh_to_empty,
    "lookback_runs": lookback_runs,
    "merged_batches": merged_batches,
    "dimension_change": dimension_change,
    "dimension_runs": dimension_runs,
    "changed_days": changed_days,
    "indexed_days": indexed_days,
    "delta_mart": delta_mart,
    "replayed_rejects": replayed_rejects,
    "resumed_load": resumed_load,
    "load_slices": load_slices,
}
