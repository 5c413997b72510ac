"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import free_names


def latest_per_key(
    df: DataFrame, key: Sequence[str], time: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the newest by ``time``, nulls last, ties by ``tiebreak``.

    Without a tie-break every remaining column takes part in the order.  A total
    order matters on a cluster: a task that runs again must pick the same row.

    ``row_number() = 1`` lets Spark keep only the best row per key in each map
    task, before the shuffle.  A key that holds a third of all rows therefore
    sends one row per map task to its reducer.
    """
    settle = tiebreak or [c for c in df.columns if c not in (*key, time)]
    order = [F.desc_nulls_last(c) for c in (time, *settle)]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    (version,) = free_names(df.columns, "_version")
    return df.withColumn(version, rank).filter(F.col(version) == 1).drop(version)
