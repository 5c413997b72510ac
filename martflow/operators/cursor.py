"""Selecting the rows beyond a stored cursor, and finding the next cursor."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import event_time, free_names, time_literal, time_text, time_type


def rows_after(
    df: DataFrame,
    cursor: str | None,
    column: str,
    lookback: str | None = None,
    upto: str | None = None,
    unreadable: bool = False,
) -> DataFrame:
    """Rows strictly newer than ``cursor``; all rows where there is none.

    ``lookback`` (such as ``"2 hours"``) moves the lower bound back, so that rows
    that arrive late are read again.  ``upto`` closes the range from above.
    ``unreadable`` keeps rows without a time, which no bound can place.  The
    bounds are typed literals, so Parquet and partition statistics apply.
    """
    kind, time = time_type(df, column), event_time(df, column)
    if cursor is not None:
        bound = time_literal(kind, cursor)
        if lookback:
            bound = (bound - F.expr(f"INTERVAL {lookback}")).cast(kind)
        df = df.filter((time > bound) | time.isNull() if unreadable else time > bound)
    if upto is not None:
        df = df.filter(time <= time_literal(kind, upto))
    return df


def not_known(
    rows: DataFrame, known: DataFrame, key: Sequence[str], column: str, ties: Sequence[str], cursor: str
) -> DataFrame:
    """``rows`` without those up to the cursor that a known version equals or beats.

    A row that is read again, and one that a newer version of its key has overtaken,
    change nothing.  Only known versions from the oldest of these rows on are read.
    """
    kind, time = time_type(rows, column), F.col(column)
    bound = time_literal(kind, cursor)
    oldest = rows.filter(time <= bound).agg(F.min(time)).scalar()
    order = [column, *ties]
    best, *own = free_names(rows.columns, "_known", *(f"_known_{c}" for c in key))
    newest = (
        known.filter(time >= oldest)
        .groupBy(*(F.col(c).alias(name) for c, name in zip(key, own)))
        .agg(F.max(F.struct(*order)).alias(best))
    )
    same = reduce(and_, (F.col(c) == F.col(name) for c, name in zip(key, own)))
    beaten = (time <= bound) & F.col(best).isNotNull() & (F.struct(*order) <= F.col(best))
    return rows.join(newest, same, "left").filter(~F.coalesce(beaten, F.lit(False))).select(*rows.columns)


def high_mark(df: DataFrame, column: str, cursor: str | None = None) -> Column:
    """Aggregate expression: the newest time in ``df`` as cursor text, null if none.

    With ``cursor``, the result is never older than it; rows that a lookback reads
    again must not move a cursor backwards.
    """
    kind, newest = time_type(df, column), F.max(event_time(df, column))
    if cursor is not None:
        newest = F.when(newest.isNotNull(), F.greatest(newest, time_literal(kind, cursor)))
    return time_text(kind, newest)


def batch_high(df: DataFrame, column: str, name: str = "high_watermark") -> DataFrame:
    """The newest time of ``df`` as a one-row frame."""
    return df.agg(high_mark(df, column).alias(name))
