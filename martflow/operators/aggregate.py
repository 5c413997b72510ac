"""Aggregated tables from declared measures."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DataType, DoubleType, FloatType

from ..functions import amount, cents_parts, cents_total, exact_ratio, from_cents
from .lookup import lookup


@dataclass(frozen=True)
class Sum:
    name: str
    column: str


@dataclass(frozen=True)
class Money(Sum):
    """Exact sum of amounts, reported in currency units.

    A column of integers holds whole cents, one of doubles or decimals currency units.
    """


@dataclass(frozen=True)
class CountDistinct:
    name: str
    column: str


@dataclass(frozen=True)
class Ratio:
    """One measure over another, rounded half-up; null where the divisor is zero or null.

    Money, counts and sums of whole numbers are divided exactly, sums of doubles as such.
    """

    name: str
    numerator: str
    denominator: str
    scale: int = 2


Measure = Sum | CountDistinct | Ratio


@dataclass(frozen=True)
class Lookup:
    """A dimension whose ``columns`` are part of the grain."""

    fact_key: str
    dim_key: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class MartSpec:
    day: str
    grain: tuple[str, ...]
    measures: tuple[Measure, ...]
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    lookup: Lookup | None = None
    #: For a counted column, other columns that have one value for each of its values.
    determines: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self):
        known = {m.name for m in self.measures if not isinstance(m, Ratio)}
        for m in self.measures:
            if isinstance(m, Ratio) and not {m.numerator, m.denominator} <= known:
                raise ValueError(f"{m.name} divides something that is not a sum or count here")

    @property
    def columns(self) -> list[str]:
        return [*self.grain, *(m.name for m in self.measures)]


def with_derived(rows: DataFrame, spec: MartSpec) -> DataFrame:
    return rows.withColumns({name: make() for name, make in spec.derived.items()})


def build_mart(
    rows: DataFrame,
    spec: MartSpec,
    unique_on: tuple[str, ...] = (),
    dimension: DataFrame | None = None,
    reduced: bool = False,
) -> DataFrame:
    """Aggregate ``rows`` to ``spec.grain``.

    ``unique_on`` states a key that ``rows`` is already unique on.  A distinct
    count of that key is then a plain count.  Where a counted column determines the
    other counted ones, rows are first reduced to one for each of its values, and it is
    counted plainly too.  With one distinct count left, Spark aggregates in map tasks by
    (grain, counted value) and needs no row expansion; a hot group is spread over its
    counted values.

    With a lookup, facts are first reduced to (fact grain, lookup key, counted
    values).  Only that reduced set meets the dimension.  ``reduced`` states that the
    dimension has one row per key; written first, it lets a hot lookup key be split.
    """
    rows = with_derived(rows, spec)
    kinds = {f.name: f.dataType for f in rows.schema}
    parts = {name: e for m in spec.measures if isinstance(m, Sum) for name, e in _parts(m, kinds)}
    distinct = [m for m in spec.measures if isinstance(m, CountDistinct)]
    plain = [m for m in distinct if unique_on == (m.column,)]
    exact = [m for m in distinct if m not in plain]
    sums = [F.sum(e).alias(name) for name, e in parts.items()]
    counts = [F.count(m.column).alias(m.name) for m in plain]
    merged = [F.sum(name).alias(name) for name in [*parts, *(m.name for m in plain)]]

    if spec.lookup is not None:
        if dimension is None:
            raise ValueError("this mart looks up a dimension, but none was given")
        brought = spec.lookup.columns
        held = [c for c in spec.grain if c not in brought]
        rows = _reduced(rows, [*held, spec.lookup.fact_key, *(m.column for m in exact)], [*sums, *counts])
        rows = lookup(rows, dimension, spec.lookup.fact_key, spec.lookup.dim_key, brought, reduced)
    elif lead := _determining(exact, spec):
        rows = _reduced(rows, [*spec.grain, *(m.column for m in exact)], [*sums, *counts])
        merged += [F.count(lead.column).alias(lead.name)]
        exact = [m for m in exact if m is not lead]
    else:
        merged = [*sums, *counts]

    grouped = rows.groupBy(*spec.grain).agg(
        *merged, *(F.count_distinct(m.column).alias(m.name) for m in exact)
    )
    by_name = {m.name: m for m in spec.measures}
    return grouped.select(*spec.grain, *(_report(m, by_name, kinds).alias(m.name) for m in spec.measures))


def _parts(measure: Sum, kinds: Mapping[str, DataType]) -> list[tuple[str, Column]]:
    """Named columns to sum for a measure."""
    if not isinstance(measure, Money):
        return [(measure.name, F.col(measure.column))]
    parts = cents_parts(F.col(measure.column), kinds[measure.column])
    return [(f"_{measure.name}_{k}", part) for k, part in enumerate(parts)]


def _reduced(rows: DataFrame, by: list[str], aggregates: list[Column]) -> DataFrame:
    unique = dict.fromkeys(by)
    return rows.groupBy(*unique).agg(*aggregates) if aggregates else rows.select(*unique).distinct()


def _determining(counted: list[CountDistinct], spec: MartSpec) -> CountDistinct | None:
    """The counted column that determines all the others, if two or more are counted."""
    for m in counted:
        others = {o.column for o in counted if o is not m}
        if others and others <= set(spec.determines.get(m.column, ())):
            return m
    return None


def _cents(measure: Money, kinds: Mapping[str, DataType]) -> Column:
    return cents_total([F.col(name) for name, _ in _parts(measure, kinds)])


def _report(
    measure: Measure, by_name: Mapping[str, Measure], kinds: Mapping[str, DataType]
) -> Column:
    if isinstance(measure, Money):
        return from_cents(_cents(measure, kinds))
    if not isinstance(measure, Ratio):
        return F.col(measure.name)
    over, under = by_name[measure.numerator], by_name[measure.denominator]
    if any(_is_floating(m, kinds) for m in (over, under)):
        top, bottom = (_report(m, by_name, kinds).cast("double") for m in (over, under))
        return F.round(top / F.nullif(bottom, F.lit(0.0)), measure.scale)
    top, bottom = (
        _cents(m, kinds) if isinstance(m, Money) else F.col(m.name) for m in (over, under)
    )
    shift = 2 * (isinstance(under, Money) - isinstance(over, Money))
    return exact_ratio(top, bottom, measure.scale, shift)


def _is_floating(measure: Measure, kinds: Mapping[str, DataType]) -> bool:
    plain_sum = isinstance(measure, Sum) and not isinstance(measure, Money)
    return plain_sum and isinstance(kinds[measure.column], (DoubleType, FloatType))


#: Revenue, orders, customers, units and average order value by day and category.
DAILY_CATEGORY_MART = MartSpec(
    day="order_date",
    grain=("order_date", "category"),
    measures=(
        Money("total_revenue", "revenue"),
        CountDistinct("orders", "order_id"),
        CountDistinct("customers", "customer_id"),
        Sum("units", "quantity"),
        Ratio("avg_order_value", "total_revenue", "orders"),
    ),
    derived={"revenue": lambda: amount(F.col("quantity"), F.col("unit_price"))},
)
