"""Time the headline queries on one machine and print one JSON line.

Each query runs twice and the second run counts, so that JVM warm-up is left out.
A result is computed whole and thrown away by the noop sink.  Queries that publish
run their whole flow, writes included.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workloads.queries import QUERIES  # noqa: E402

HEADLINE = [
    "daily_mart",
    "country_mart",
    "brand_mart",
    "select_new",
    "rejected_rows",
    "latest_per_key",
    "enrich_left",
    "orphans_anti",
    "quality_report",
    "volume_anomaly_by_day",
    "affected_days",
    "rebuild_affected",
    "first_load",
    "append_batches",
    "incremental_mart",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("martflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    timed = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        timed[name] = round(seconds(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(Path(folder).name.removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
