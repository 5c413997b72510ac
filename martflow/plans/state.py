"""The stored state of a mart that is maintained by differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.aggregate import MartSpec
from ..operators.deltas import (
    VALUE,
    counted_moves,
    group_deltas,
    group_schema,
    mart_from_groups,
    referenced,
    signed_rows,
    value_references,
    value_schema,
)
from .scratch import written
from .sides import SideTable


class MartState:
    """Group rows, bucketed by day, and value rows for each distinct count, by grain and value.

    Only the buckets that a batch's rows fall into are read: what a batch costs follows its
    size, not that of the days it touches.  ``facts`` gives the types of the fact layer.
    """

    def __init__(
        self,
        spark: SparkSession,
        mart: str,
        facts: DataFrame,
        spec: MartSpec,
        unique_on: tuple[str, ...],
        buckets: int,
    ):
        self.facts, self.spec, self.unique_on = facts, spec, unique_on
        self.root = mart.rstrip("/")
        groups = group_schema(facts, spec, unique_on)
        self.groups = SideTable(spark, f"{self.root}.groups", groups, [spec.day], buckets)
        self.values = {
            m.name: SideTable(
                spark, f"{self.root}.values_{m.name}", value_schema(facts, spec, m),
                [*spec.grain, VALUE], buckets,
            )
            for m in referenced(spec, unique_on)
        }

    @property
    def name(self) -> str:
        return self.groups.name

    def _scratch(self, name: str) -> str:
        return f"{self.root}.scratch/{name}"

    def add(self, fresh: DataFrame, superseded: DataFrame, epoch: int, batch: int) -> None:
        """Add what a batch changes: current rows that come, and those that go."""
        rows = written(signed_rows(fresh, superseded), self._scratch("signed"))
        counted = {}
        for measure in referenced(self.spec, self.unique_on):
            table = self.values[measure.name]
            table.add(value_references(rows, self.spec, measure), epoch, batch)
            moves = table.read_batch(epoch, batch).select(*table.schema.names)
            known = table.read(epoch, batch - 1, numbers=table.numbers(epoch, batch))
            counted[measure.name] = counted_moves(moves, known, self.spec, measure)
        self.groups.add(group_deltas(rows, self.spec, self.unique_on, counted), epoch, batch)

    def days(self, epoch: int, batch: int, day: str) -> DataFrame:
        """Days that a batch has rows for, or had rows taken from."""
        changed = self.groups.read_batch(epoch, batch)
        return changed.select(day).distinct().coalesce(1)

    def mart(self, days: DataFrame, epoch: int, last: int) -> DataFrame:
        """The mart on ``days``, a written table."""
        day = self.spec.day
        groups = self.groups.read(epoch, last, days).join(days.select(day), day, "left_semi")
        return mart_from_groups(groups, self.facts, self.spec, self.unique_on)

    def retire(self, epoch: int) -> None:
        for table in (self.groups, *self.values.values()):
            table.retire(epoch)
