"""Which partitions a batch affects, and the current rows of those partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import free_names
from ..sources import Contract
from .latest import latest_per_key

KEYS_APART = 256


def touched_days(batch: DataFrame, day: str) -> DataFrame:
    """Distinct days of a batch, kept as a frame."""
    return batch.select(day).distinct()


def rows_on_days(df: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Rows whose day is listed in ``days``; no rows for an empty list."""
    return df.join(days.select(day), day, "left_semi")


def affected_days(batch: DataFrame, history: DataFrame, contract: Contract) -> DataFrame:
    """Days of the batch, and the days where its keys already have versions.

    A correction may move a key to another day; the day it leaves changes too.
    ``batch`` has one row per key and should be a written table: adaptive execution
    can then split a key with very many versions on the history side.
    The history scan reads the key columns only, and only where Parquet statistics
    allow for a key in the batch's range; with keys that grow over time that leaves
    little to read.  Its join turns into a map-side lookup when the batch's keys
    are small, and Spark decides that from their measured size.  What is shuffled
    after it is distinct days per map task.
    """
    keys = batch.select(*contract.key)
    lead = contract.key[0]
    in_range = F.col(lead).between(
        batch.agg(F.min(lead)).scalar(), batch.agg(F.max(lead)).scalar()
    )
    moved = (
        history.select(*contract.key, contract.day)
        .filter(in_range)
        .join(keys, [*contract.key], "left_semi")
    )
    return batch.select(contract.day).union(moved.select(contract.day)).distinct()


def days_of_some_keys(batch: DataFrame, history: DataFrame, contract: Contract) -> list:
    """Affected days that need no large join: the batch's own, and those of every 256th of its keys.

    Where a batch is wide these are nearly all, and the join for the rest leaves the history's
    rows on them out.  One value a calendar day comes to the driver.
    """
    some = batch.filter(F.pmod(F.xxhash64(*contract.key), F.lit(KEYS_APART)) == 0)
    days = touched_days(batch, contract.day).union(affected_days(some, history, contract))
    return [row[0] for row in days.distinct().collect()]


def current_rows(
    history: DataFrame, days: DataFrame, first_day, contract: Contract, complete: bool = False
) -> DataFrame:
    """The newest version of each key, for the keys whose newest version is on ``days``.

    Equals deduplicating all of ``history`` and then keeping ``days``, without
    reading the partitions before ``first_day`` (the smallest of ``days``): time
    decides which version wins and the day follows from time, so a newer version
    is never on an earlier day.

    Other days from ``first_day`` on can hold a newer version.  Only the keys on ``days``
    matter there, so these days are joined with those keys first: a lookup in the map
    tasks where the keys are few, by measured size, and no aggregate of other keys in any
    case.  They contribute keys and partition values only.

    ``complete`` states that ``days`` has every day of ``history`` from ``first_day`` on, so
    that there is nothing to look for elsewhere.
    """
    key, day = [*contract.key], contract.day
    (later,) = free_names(history.columns, "_later")
    recent = history.filter(F.col(day) >= F.lit(first_day))
    if complete:
        return latest_per_key(recent, key, contract.time, contract.ties).select(*history.columns)
    listed = days.filter(F.col(day) >= F.lit(first_day)).select(day)

    on_days = recent.join(listed, day, "left_semi")
    best = latest_per_key(on_days, key, contract.time, contract.ties)
    newest_elsewhere = (
        recent.select(*key, day)
        .join(listed, day, "left_anti")
        .join(on_days.select(*key), key, "left_semi")
        .groupBy(*key)
        .agg(F.max(day).alias(later))
    )
    kept = best.join(newest_elsewhere, key, "left").filter(
        F.col(later).isNull() | (F.col(later) < F.col(day))
    )
    return kept.select(*history.columns)
