"""Time the package against the plain way to do the same step, on multiplied events.

    python benchmarks/alternatives.py <sf folder> <copies> <scratch folder>

Writes ``copies`` shifted copies of the events in time order and then times, each
as the second of two runs: an incremental run of the last day against a full
rebuild, the audit in one action against one action per check, and a rebuild of
the last day's rows against deduplicating the whole fact layer.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bench import session  # noqa: E402
from martflow.operators import (  # noqa: E402
    DAILY_CATEGORY_MART,
    audit,
    build_mart,
    current_rows,
    latest_per_key,
    orphan_keys,
    parse_time,
    rows_after,
    valid_rows,
)
from martflow.plans import RETAIL_CHECKS, Flow, FlowSpec, scratch_folder, volume_history, written  # noqa: E402
from workloads.tables import EVENT_ORDERS, customers, event_orders  # noqa: E402

LAST_DAY = dt.date(2024, 1, 30)


def timed(action) -> float:
    begun = time.perf_counter()
    action()
    return round(time.perf_counter() - begun, 2)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def multiplied(spark, folder: str, copies: int, path: str):
    """Events repeated with new ids, a few milliseconds apart, in time-ordered files."""
    rows = event_orders(spark, folder).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    shifted = rows.select(
        (F.col("order_id") * copies + F.col("c")).alias("order_id"),
        "customer_id",
        (F.col("order_ts") + F.make_dt_interval(secs=F.col("c") / 1000)).alias("order_ts"),
        "category", "quantity", "unit_price",
    ).filter(F.to_date("order_ts") <= F.lit(LAST_DAY))
    shifted.repartitionByRange(32, "order_ts").write.parquet(path)
    return lambda s: s.read.schema(EVENT_ORDERS.schema).parquet(path)


def flow_of(spark, source, folder, root) -> Flow:
    return Flow(spark, FlowSpec(
        source=source, dimension=lambda s: customers(s, folder),
        clean=f"{root}/clean", mart=f"{root}/mart", ledger=f"{root}/ledger",
        contract=EVENT_ORDERS, mart_spec=DAILY_CATEGORY_MART, checks=RETAIL_CHECKS,
    ))


def one_action_per_check(batch, people) -> None:
    batch.count()
    batch.filter(F.col("order_id").isNull()).count()
    batch.count(), batch.select("order_id").distinct().count()
    batch.filter(F.col("unit_price") < 0).count()
    orphan_keys(batch, "customer_id", people, "customer_id").count()


def main() -> None:
    folder, copies, root = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    spark = session("8")
    source = multiplied(spark, folder, copies, f"{root}/raw")
    result = {"rows": source(spark).count()}

    for attempt in ("cold", "warm"):
        home = f"{root}/{attempt}"
        until = lambda s: rows_after(source(s), None, "order_ts", upto=f"{LAST_DAY - dt.timedelta(1)} 23:59:59.999999")
        result["first load, 29 days"] = timed(flow_of(spark, until, folder, home).run)
        grown = flow_of(spark, source, folder, home)
        result["incremental run, last day"] = timed(lambda: grown.run(accept_volume=True))
        result["full refresh, 30 days"] = timed(lambda: grown.run(full_refresh=True))

        clean, people = grown.clean(), customers(spark, folder)
        history = volume_history(grown.ledger())
        result["checks, one action"] = timed(lambda: audit(clean, RETAIL_CHECKS, history, people).collect())
        result["checks, one action each"] = timed(lambda: one_action_per_check(clean, people))
        parsed = parse_time(source(spark), EVENT_ORDERS)
        unstaged = latest_per_key(valid_rows(parsed, EVENT_ORDERS.rules), ["order_id"], "order_ts")
        result["checks, one action each, batch not staged"] = timed(
            lambda: one_action_per_check(unstaged, people))

        days = written(spark.createDataFrame([(LAST_DAY,)], "order_date date"), f"{scratch_folder(spark)}/days")
        bounded = current_rows(clean, days, LAST_DAY, EVENT_ORDERS)
        whole = latest_per_key(clean, ["order_id"], "order_ts").filter(F.col("order_date") == F.lit(LAST_DAY))
        result["last day rebuilt from its partitions"] = timed(
            lambda: consume(build_mart(bounded, DAILY_CATEGORY_MART, ("order_id",))))
        result["last day rebuilt from the whole layer"] = timed(
            lambda: consume(build_mart(whole, DAILY_CATEGORY_MART, ("order_id",))))

    print(json.dumps(result, indent=1))
    spark.stop()


if __name__ == "__main__":
    main()
