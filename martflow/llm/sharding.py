"""Weighted rendezvous hashing of record keys, with gapless slots in each shard.

Every (key, shard) pair gets a hash u in (0, 1) and the score ``weight / -ln(u)``; the
shard with the highest score takes the record.  A shard's score does not depend on the
others, so an added shard can only take records into itself, a removed one only gives
its own away, and each shard's share is proportional to its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import free_names, unit_hash


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to ``len(weights) - 1``, that a key belongs to.

    Keys are compared as text, so an id hashes alike as int and as long.  A null key is
    a key like any other.  Equal scores go to the lower shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    text = F.coalesce(key.cast("string"), F.lit("\0null"))
    scored = [
        F.struct(
            (F.lit(float(weight)) / -F.log(unit_hash(text, F.lit(shard)))).alias("score"),
            F.lit(-shard).alias("shard"),
        )
        for shard, weight in enumerate(weights)
    ]
    best = scored[0] if len(scored) == 1 else F.greatest(*scored)
    return (-best["shard"]).cast("int")


def with_slots(rows: DataFrame, shard: str, slot: str) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in reading order.

    Rows are first written with the task that read them, so that the numbering is fixed
    whatever executor is lost later.  Each (task, shard) group is numbered by itself and
    moved up by the rows that earlier tasks gave the shard.  No group is larger than
    what one task reads, however the keys are spread.
    """
    part, order, before, count = free_names(rows.columns, "part", "order", "before", "count")
    staged = written(
        rows.withColumns({part: F.spark_partition_id(), order: F.monotonically_increasing_id()}),
        f"{scratch_folder(rows.sparkSession)}/shards",
    )
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(part, shard)
        .agg(F.count(F.lit(1)).alias(count))
        .select(part, shard, F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(before))
    )
    within = F.row_number().over(Window.partitionBy(part, shard).orderBy(order)) - 1
    return (
        staged.withColumn(slot, within)
        .join(offsets, [part, shard])
        .withColumn(slot, (F.col(slot) + F.col(before)).cast("long"))
        .select(*rows.columns, slot)
    )


def assign_shards(
    df: DataFrame, key: str, weights: Sequence[float], grown_weights: Sequence[float] | None = None
) -> DataFrame:
    """Add ``shard`` and ``slot``, and ``grown_shard`` for a second list of weights.

    Repeated rows and repeated keys share a shard and get slots of their own.  An empty
    table gives an empty table.  Existing columns of these names are kept as they are;
    the new ones then get an underscore in front.
    """
    shard, grown, slot = free_names(df.columns, "shard", "grown_shard", "slot")
    placed = df.withColumn(shard, rendezvous_shard(F.col(key), weights))
    if grown_weights is not None:
        placed = placed.withColumn(grown, rendezvous_shard(F.col(key), grown_weights))
    return with_slots(placed, shard, slot)
