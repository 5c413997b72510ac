"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written


def _starred(edges: DataFrame, larger_only: bool, path: str) -> DataFrame:
    """Link neighbours of each node to the smallest one around it.

    ``larger_only`` is the large star: only neighbours above the node are linked.
    Otherwise, the small star, only neighbours below it are.  The smallest ones are written
    to ``path`` first: the join then reads two shuffles, and adaptive execution can split
    a node that a large part of all edges meet.
    """
    both = edges if not larger_only else edges.unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    # ``a`` is the centre and ``b`` its neighbour.
    if not larger_only:
        both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = written(both.groupBy("a").agg(F.min("b").alias("low")), path)
    linked = both.join(lowest, "a")
    if larger_only:
        low = F.least("low", "a")
        linked = linked.filter("b > a").select(F.col("b").alias("a"), low.alias("b"))
    else:
        linked = linked.select(
            F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("low").alias("b"),
        )
    return linked.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is its component's minimum.

    The number of rounds grows with the logarithm of the component size.  Each round is
    written to the session's scratch folder, so a lost executor costs one round at most;
    only a count and a checksum come to the driver.
    """
    spark = edges.sparkSession
    folder = scratch_folder(spark)
    current, before, turn = written(edges.select("a", "b").filter("a <> b"), f"{folder}/0"), None, 0
    while True:
        turn += 1
        large = written(_starred(current, True, f"{folder}/{turn}-low"), f"{folder}/{turn}-large")
        current = written(_starred(large, False, f"{folder}/{turn}-lower"), f"{folder}/{turn}")
        after = current.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)
        ).first()
        if after == before:
            break
        before = after
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = leaves.select(F.col("root").alias("node"), "root").distinct()
    return leaves.unionByName(roots)
