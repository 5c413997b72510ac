"""Event-time expressions: parsing, day keys and exact cursor text.

A cursor leaves Spark as text and comes back as a typed literal.  Both
directions run inside Spark, so the driver's time zone never takes part, and
microseconds are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

_TIME_TYPES = (DateType, TimestampNTZType, TimestampType)
#: A zone after a time of day: an offset, Z or a name.
_OFFSET = r"\d:\d\d(:\d\d(\.\d+)?)?\s*([+-]|Z|[A-Za-z])"


def parsed_type(kind: DataType) -> DataType:
    """What a column of type ``kind`` becomes when parsed: text a zoneless timestamp."""
    return kind if isinstance(kind, _TIME_TYPES) else TimestampNTZType()


def time_type(df: DataFrame, column: str) -> DataType:
    """The type ``event_time`` gives ``column``."""
    return parsed_type(df.schema[column].dataType)


def event_time(df: DataFrame, column: str) -> Column:
    """``column`` as a time value; text that is not a timestamp becomes null.

    A column that already holds a time is passed on untouched, so that a filter
    on it still reaches the Parquet scan.  Text is read as the clock shows it, in a gap of
    summer time too.  Text with an offset names an instant, and becomes what the clock of
    the session's zone shows then.
    """
    if isinstance(df.schema[column].dataType, _TIME_TYPES):
        return F.col(column)
    text = F.col(column)
    instant = F.try_to_timestamp(text).cast(TimestampNTZType())
    return F.when(text.rlike(_OFFSET), instant).otherwise(text.try_cast(TimestampNTZType()))


def time_literal(kind: DataType, text: str) -> Column:
    """Cursor text as a literal of exactly the column's type."""
    return F.lit(text).cast(kind)


def time_text(kind: DataType, value: Column) -> Column:
    """A time as text that ``time_literal`` reads back without loss.

    Zoneless times print as they are.  Instants carry their offset, so the text
    means the same under any session time zone.
    """
    if isinstance(kind, TimestampType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return value.cast("string")
