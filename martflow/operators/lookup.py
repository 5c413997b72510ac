"""Dimension lookup and missing-key search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import free_names


def one_row_per_key(dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Dimension reduced to one row per key, so that a join cannot multiply facts.

    Of several rows with one key, the greatest by ``columns`` in order is kept.
    """
    (row,) = free_names([key], "_row")
    best = F.max(F.struct(*columns)).alias(row)
    return dimension.groupBy(key).agg(best).select(key, *(F.col(row)[c].alias(c) for c in columns))


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: Sequence[str],
    reduced: bool = False,
) -> DataFrame:
    """Left-join ``columns`` of the dimension; facts without a match keep nulls.

    There is no broadcast hint.  Spark broadcasts the dimension when its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.

    ``reduced`` states that the dimension already has one row per key.  For large
    facts, reduce it with ``one_row_per_key`` and write the result first: its file
    size is then known, and adaptive execution splits the partition of a hot fact
    key.  It cannot do so where an aggregate stands between shuffle and join.
    """
    if not reduced:
        dimension = one_row_per_key(dimension, dim_key, columns)
    (own,) = free_names([*facts.columns, *columns], "_dim_key")
    brought = dimension.select(F.col(dim_key).alias(own), *columns)
    return facts.join(brought, F.col(fact_key) == F.col(own), "left").drop(own)


def orphan_keys(facts: DataFrame, key: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    """Distinct fact keys with no dimension row.  A null key is one orphan.

    Both sides are made distinct first.  That happens in the map tasks, so a hot
    key is a single row by the time it is shuffled.
    """
    (own,) = free_names([key], "_known")
    known = dimension.select(F.col(dim_key).alias(own)).distinct()
    wanted = facts.select(key).distinct()
    return wanted.join(known, F.col(key) == F.col(own), "left_anti")
