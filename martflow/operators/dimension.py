"""What a dimension that changes does to published days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import free_names


def dimension_changes(
    before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Keys that came, went, or have other ``columns`` now; each once.  Null equals null.

    Both states have one row per key.  Rows that are the same in both cancel out in one
    aggregate over their union; what is shuffled again are the changed keys only.
    """
    (sign,) = free_names([key, *columns], "sign")
    states = [
        state.select(key, *columns, F.lit(value).alias(sign)) for state, value in ((before, -1), (after, 1))
    ]
    left = states[0].unionAll(states[1]).groupBy(key, *columns).agg(F.sum(sign).alias(sign))
    return left.filter(F.col(sign) != 0).select(key).distinct()


def days_of_keys(
    history: DataFrame, column: str, keys: DataFrame, key: str, day: str
) -> DataFrame:
    """Distinct days on which ``history`` has a row whose ``column`` is one of ``keys``.

    ``keys`` should be a written table of distinct values: the join is then a lookup in the
    map tasks where they are few, by measured size, and can split a hot value otherwise.
    The history scan reads two columns.
    """
    (own,) = free_names(history.columns, "changed_key")
    wanted = keys.select(F.col(key).alias(own))
    rows = history.select(column, day)
    return rows.join(wanted, F.col(column) == F.col(own), "left_semi").select(day).distinct()
