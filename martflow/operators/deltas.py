"""Marts kept up to date by differences: what a batch adds, less what it supersedes.

A mart's state is a log of two kinds of rows.  Group rows have sums and counts for a grain;
value rows have, for each counted column, how many current rows bring a value to a grain.
Every batch appends its own rows: plus for a row that becomes current, minus for the one it
takes the place of.  A group is the sum of its rows, and a distinct count moves only where a
value's references leave zero or come back to it.

All sums are whole numbers or decimals, so taking away gives back exactly what was added.
Columns of doubles that are no money are summed to nine decimal places.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, LongType, StructField, StructType

from ..functions import free_names
from .aggregate import CountDistinct, MartSpec, Money, Sum, _parts, _report, with_derived

SIGN, ROWS, REFERENCES, VALUE = "_sign", "_rows", "_references", "_value"
PLACES = "decimal(38,9)"
FEW_MOVES = 100_000  # a lookup in the map tasks; a join of more would shuffle all earlier rows once more


def _measured(spec: MartSpec, unique_on: tuple[str, ...]) -> tuple[list[Sum], list[CountDistinct], list[CountDistinct]]:
    """Sums, counts of the unique key, and counts that need references."""
    sums = [m for m in spec.measures if isinstance(m, Sum)]
    counted = [m for m in spec.measures if isinstance(m, CountDistinct)]
    plain = [m for m in counted if unique_on == (m.column,)]
    return sums, plain, [m for m in counted if m not in plain]


def _summed(measure: Sum, kinds: Mapping[str, DataType]) -> list[tuple[str, Column]]:
    """Named exact columns to sum for a measure."""
    if not isinstance(measure, Money) and isinstance(kinds[measure.column], (DoubleType, FloatType)):
        return [(measure.name, F.col(measure.column).try_cast(PLACES))]
    return _parts(measure, kinds)


def _signed(value: Column) -> Column:
    return F.when(F.col(SIGN) < 0, -value).otherwise(value)


def signed_rows(fresh: DataFrame, superseded: DataFrame) -> DataFrame:
    """Rows that become current, plus, and those whose place they take, minus."""
    return fresh.withColumn(SIGN, F.lit(1)).unionByName(superseded.withColumn(SIGN, F.lit(-1)))


def value_references(rows: DataFrame, spec: MartSpec, measure: CountDistinct) -> DataFrame:
    """``grain..., _value, _references``: how a batch of signed rows moves them; zeros left out."""
    rows = with_derived(rows, spec).filter(F.col(measure.column).isNotNull())
    return (
        rows.groupBy(*spec.grain, F.col(measure.column).alias(VALUE))
        .agg(F.sum(SIGN).cast("long").alias(REFERENCES))
        .filter(F.col(REFERENCES) != 0)
    )


def counted_moves(moves: DataFrame, known: DataFrame, spec: MartSpec, measure: CountDistinct) -> DataFrame:
    """``grain..., measure``: by how much a distinct count changes.

    ``moves`` are a batch's value rows, one for each grain and value, ``known`` the earlier
    ones.  Both should be written tables.  Few moves are looked up in the earlier rows before
    these are shuffled; beside many, all rows meet in one shuffle by grain and value, and
    groups without a move go.
    """
    pair = [*spec.grain, VALUE]
    if moves.count() <= FEW_MOVES:
        own = free_names(known.columns, *(f"own_{c}" for c in pair))
        wanted = moves.select(*(F.col(c).alias(name) for c, name in zip(pair, own)))
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(name)) for c, name in zip(pair, own)))
        known = known.join(wanted, same, "left_semi")
    both = moves.withColumn(SIGN, F.lit(1)).unionByName(known.withColumn(SIGN, F.lit(0)))
    old = F.sum(F.when(F.col(SIGN) == 0, F.col(REFERENCES)).otherwise(0))
    totals = both.groupBy(*pair).agg(
        F.sum(REFERENCES).alias("after"), old.alias("before"), F.max(SIGN).alias("moved")
    )
    change = (F.col("after") > 0).cast("long") - (F.col("before") > 0).cast("long")
    return totals.filter("moved = 1").groupBy(*spec.grain).agg(F.sum(change).alias(measure.name))


def group_deltas(
    rows: DataFrame, spec: MartSpec, unique_on: tuple[str, ...], counted: Mapping[str, DataFrame]
) -> DataFrame:
    """The group rows of a batch of signed rows.

    ``counted`` has the change of each distinct count, by the measure's name.  The rows of
    ``group_schema``: a sum and a count of its amounts for each part, for a sum over none is null.
    """
    rows = with_derived(rows, spec)
    kinds = {f.name: f.dataType for f in rows.schema}
    sums, plain, exact = _measured(spec, unique_on)
    found = [F.sum(SIGN).cast("long").alias(ROWS)]
    for measure in sums:
        for name, part in _summed(measure, kinds):
            found.append(F.sum(_signed(part)).alias(name))
            found.append(F.sum(F.when(part.isNotNull(), F.col(SIGN))).cast("long").alias(f"{name}_amounts"))
    found += [F.sum(F.when(F.col(m.column).isNotNull(), F.col(SIGN))).cast("long").alias(m.name) for m in plain]
    groups = rows.groupBy(*spec.grain).agg(*found)
    parts = [groups]
    parts += [counted[m.name] for m in exact]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    merged = [F.sum(c).alias(c) for c in union.columns if c not in spec.grain]
    return _typed(union.groupBy(*spec.grain).agg(*merged), group_schema(rows, spec, unique_on))


def _typed(frame: DataFrame, schema: StructType) -> DataFrame:
    return frame.select(*(F.coalesce(F.col(f.name), F.lit(0)).cast(f.dataType).alias(f.name) if f.nullable is False else F.col(f.name) for f in schema))


def group_schema(rows: DataFrame, spec: MartSpec, unique_on: tuple[str, ...]) -> StructType:
    """Columns of a group row; numbers are never null."""
    rows = with_derived(rows, spec)
    kinds = {f.name: f.dataType for f in rows.schema}
    sums, plain, exact = _measured(spec, unique_on)
    fields = [rows.schema[c] for c in spec.grain]
    fields = [StructField(f.name, f.dataType) for f in fields]
    numbers = [(ROWS, LongType())]
    for measure in sums:
        for name, part in _summed(measure, kinds):
            numbers += [(name, rows.select(F.sum(part).alias(name)).schema[name].dataType), (f"{name}_amounts", LongType())]
    numbers += [(m.name, LongType()) for m in (*plain, *exact)]
    return StructType([*fields, *(StructField(n, kind, nullable=False) for n, kind in numbers)])


def value_schema(rows: DataFrame, spec: MartSpec, measure: CountDistinct) -> StructType:
    rows = with_derived(rows, spec)
    grain = [StructField(c, rows.schema[c].dataType) for c in spec.grain]
    return StructType([*grain, StructField(VALUE, rows.schema[measure.column].dataType), StructField(REFERENCES, LongType())])


def referenced(spec: MartSpec, unique_on: tuple[str, ...]) -> list[CountDistinct]:
    """The measures that need value rows."""
    return _measured(spec, unique_on)[2]


def mart_from_groups(groups: DataFrame, rows: DataFrame, spec: MartSpec, unique_on: tuple[str, ...]) -> DataFrame:
    """The mart that group rows add up to; ``rows`` gives the fact layer's types only."""
    kinds = {f.name: f.dataType for f in with_derived(rows, spec).schema}
    sums, plain, exact = _measured(spec, unique_on)
    numbers = [c for c in groups.columns if c not in spec.grain]
    total = groups.groupBy(*spec.grain).agg(*(F.sum(c).alias(c) for c in numbers)).filter(F.col(ROWS) > 0)
    shown = []
    for measure in sums:
        floating = not isinstance(measure, Money) and isinstance(kinds[measure.column], (DoubleType, FloatType))
        for name, _ in _summed(measure, kinds):
            value = F.when(F.col(f"{name}_amounts") > 0, F.col(name))
            shown.append((value.cast("double") if floating else value).alias(name))
    shown += [F.col(m.name) for m in (*plain, *exact)]
    total = total.select(*spec.grain, *shown)
    by_name = {m.name: m for m in spec.measures}
    return total.select(*spec.grain, *(_report(m, by_name, kinds).alias(m.name) for m in spec.measures))
