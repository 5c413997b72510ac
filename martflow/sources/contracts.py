"""Declared table contracts: columns, keys, event time and validity rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from ..functions import is_finite, parsed_type


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate.  A row passes only where it is true, not where it is null."""

    name: str
    predicate: str

    def holds(self) -> Column:
        return F.expr(self.predicate)


@dataclass(frozen=True)
class FiniteRule(Rule):
    """A computed amount has to be a number, or null.  Named after the amount's column."""

    value: Callable[[], Column] = field(kw_only=True)

    def holds(self) -> Column:
        value = self.value()
        return value.isNull() | is_finite(value)


@dataclass(frozen=True)
class Contract:
    """What a versioned fact table looks like.

    ``key`` names the entity, ``time`` orders its versions, and ``tiebreak``
    settles versions that share a time.  With no tie-break, every other column
    is used, so the choice never depends on the order in which rows arrive.

    ``day`` is the partition column.  ``day_of`` derives it from ``time`` and
    has to be a date and monotone: a later time never falls into an earlier partition.
    The rebuild relies on that to leave earlier partitions unread.  A flow refuses a
    ``day_of`` that gives no date; that it is monotone is the contract's promise.
    """

    schema: StructType
    key: tuple[str, ...]
    time: str
    rules: tuple[Rule, ...] = ()
    tiebreak: tuple[str, ...] = ()
    day: str = "order_date"
    day_of: str = ""

    @property
    def validity(self) -> tuple[Rule, ...]:
        """The rules, completed: a row always needs its key and its time."""
        stated = {rule.predicate for rule in self.rules}
        needed = (Rule(f"{c}_present", f"{c} IS NOT NULL") for c in (*self.key, self.time))
        return (*self.rules, *(rule for rule in needed if rule.predicate not in stated))

    @property
    def ties(self) -> tuple[str, ...]:
        """Columns that settle versions with the same time."""
        return self.tiebreak or tuple(
            c for c in self.schema.names if c != self.time and c not in self.key
        )

    @property
    def day_expression(self) -> str:
        return self.day_of or f"to_date({self.time})"

    @property
    def clean_schema(self) -> StructType:
        """Schema of the fact layer: times parsed, the day column last."""
        fields = [
            StructField(f.name, parsed_type(f.dataType) if f.name == self.time else f.dataType)
            for f in self.schema
        ]
        return StructType([*fields, StructField(self.day, DateType())])


# Column names and types of the two raw tables.
ORDERS_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("order_ts", StringType()),
        StructField("category", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", DoubleType()),
    ]
)
CUSTOMERS_SCHEMA = StructType(
    [
        StructField("customer_id", StringType()),
        StructField("country", StringType()),
        StructField("signup_date", StringType()),
    ]
)

def finite_rule(name: str, amount: str) -> Rule:
    """Amounts have to be numbers.  Spark orders NaN above infinity; no number is too large."""
    return Rule(name, f"abs({amount}) < double('infinity')")


ORDER_RULES = (
    Rule("order_id_present", "order_id IS NOT NULL"),
    Rule("customer_id_present", "customer_id IS NOT NULL"),
    Rule("quantity_positive", "quantity > 0"),
    Rule("unit_price_positive", "unit_price > 0"),
    finite_rule("revenue_finite", "quantity * unit_price"),
    Rule("time_parsed", "order_ts IS NOT NULL"),
)

ORDERS = Contract(
    schema=ORDERS_SCHEMA,
    key=("order_id",),
    time="order_ts",
    rules=ORDER_RULES,
)
