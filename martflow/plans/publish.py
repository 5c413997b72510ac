"""Partitioned writes: the fact layer and the mart.

The overwrite mode is set per write, never on the session.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..operators import FAILED_RULES, touched_days
from ..sources import Contract, read_if_present

EPOCH, BATCH = "epoch", "batch_id"
RULE_VERSION = "rule_version"
DAYS_AT_ONCE = 8


def _rebalanced(df: DataFrame, day: str) -> DataFrame:
    """Rows of a day together, in partitions of the advisory size.

    Rebalancing, unlike ``repartition(day)``, lets adaptive execution split a day
    that dwarfs the others over several tasks and merge the small ones.
    """
    return df.hint("rebalance", F.col(day))


def epoch_folder(root: str, epoch: int) -> str:
    return f"{root}/{EPOCH}={epoch}"


def write_batch(
    df: DataFrame,
    root: str,
    epoch: int,
    batch: int,
    contract: Contract,
    metrics: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Write a batch into a folder of its own, beside the earlier ones.

    Batch numbers count successes, so a repeated run writes the same folder and
    replaces all that the first attempt left in it.

    Returns ``metrics``, aggregates over the written rows, observed in the writing tasks.
    They stand behind the last shuffle: Spark counts a task of a job's last stage once,
    however often it is run, but those of earlier stages again when their output is lost.
    """
    rows, observed = _rebalanced(df, contract.day), Observation()
    if metrics:
        rows = rows.observe(observed, *(found.alias(name) for name, found in metrics.items()))
    (
        rows.sortWithinPartitions(contract.day, *contract.key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(contract.day)
        .parquet(f"{epoch_folder(root, epoch)}/{BATCH}={batch}")
    )
    return dict(observed.get) if metrics else {}


def read_batches(
    spark: SparkSession, root: str, epoch: int, last: int, contract: Contract
) -> DataFrame:
    """Fact rows of an epoch up to batch ``last``, with their batch number.

    A batch that no ledger row confirms has a higher number and stays unread.
    """
    schema = StructType([*contract.clean_schema, StructField(BATCH, LongType())])
    rows = read_if_present(spark, epoch_folder(root, epoch), schema, "parquet")
    return rows.filter(F.col(BATCH) <= last)


def read_batch(
    spark: SparkSession, root: str, epoch: int, batch: int, contract: Contract
) -> DataFrame:
    """Fact rows of one batch; lists that batch's folder only."""
    folder = f"{epoch_folder(root, epoch)}/{BATCH}={batch}"
    return read_if_present(spark, folder, contract.clean_schema, "parquet")


def read_rejects(
    spark: SparkSession, root: str, epoch: int, last: int, contract: Contract
) -> DataFrame:
    """Rejected rows of an epoch up to batch ``last``, with their batch, failed rules and rule version."""
    schema = StructType([
        *contract.clean_schema, StructField(FAILED_RULES, ArrayType(StringType())),
        StructField(RULE_VERSION, StringType()), StructField(BATCH, LongType()),
    ])
    rows = read_if_present(spark, epoch_folder(root, epoch), schema, "parquet")
    return rows.filter(F.col(BATCH) <= last)


def retire_epoch(spark: SparkSession, root: str, epoch: int, contract: Contract) -> None:
    """Drop the files of a replaced epoch, by overwriting its folder with no rows."""
    (
        spark.createDataFrame([], contract.clean_schema)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(contract.day)
        .parquet(epoch_folder(root, epoch))
    )


def read_mart(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_if_present(spark, path, schema, "parquet")


def replace_days(
    fresh: DataFrame, days: Sequence | None, path: str, day: str, sort: Sequence[str]
) -> int:
    """Make ``path`` hold exactly ``fresh`` on ``days``, and leave all other days alone.

    ``days=None`` means every day: one static overwrite.  Otherwise days with rows are
    replaced by one dynamic overwrite.  A listed day without rows left is overwritten with
    an empty frame, because a dynamic overwrite never touches a day it has no row for; a
    few such days are written at a time.  ``fresh`` is read more than once and should be a
    written table.  Returns the number of emptied days.
    """
    spark = fresh.sparkSession
    mode = "static" if days is None else "dynamic"
    emptied = []
    if days is not None:
        filled = {row[day] for row in touched_days(fresh, day).collect()}  # one a calendar day
        emptied = [value for value in dict.fromkeys(days) if value not in filled]
    (
        _rebalanced(fresh, day)
        .sortWithinPartitions(day, *(c for c in sort if c != day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(day)
        .parquet(path)
    )
    empty = spark.createDataFrame([], StructType([f for f in fresh.schema if f.name != day]))

    def clear(value) -> None:
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{path}/{day}={value}"
        )

    with ThreadPoolExecutor(DAYS_AT_ONCE) as pool:
        list(pool.map(clear, emptied))
    return len(emptied)
