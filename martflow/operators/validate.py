"""Time parsing and row validity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import event_time
from ..sources import Contract, Rule

FAILED_RULES = "failed_rules"


def parse_time(df: DataFrame, contract: Contract) -> DataFrame:
    """Replace the time column by its parsed form and add the day column."""
    return df.withColumn(contract.time, event_time(df, contract.time)).withColumn(
        contract.day, F.expr(contract.day_expression)
    )


def _all_hold(rules: Sequence[Rule]) -> Column:
    return reduce(and_, (rule.holds() for rule in rules), F.lit(True))


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows for which every rule is true.  Plain ANDs, so Parquet can skip on them."""
    return df.filter(_all_hold(rules))


def is_rejected(rules: Sequence[Rule]) -> Column:
    """True exactly for the rows ``valid_rows`` drops, unknown outcomes included."""
    return ~F.coalesce(_all_hold(rules), F.lit(False))


def rejected_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The complement of ``valid_rows``, each row with the names of the rules it failed."""
    failed = F.array_compact(
        F.array(*(F.when(~F.coalesce(r.holds(), F.lit(False)), F.lit(r.name)) for r in rules))
    )
    return df.filter(is_rejected(rules)).withColumn(FAILED_RULES, failed)
