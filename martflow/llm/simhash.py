"""Near duplicates by SimHash, with pigeonring filtering before the Hamming check.

A fingerprint has 64 bits.  Cut into m segments on a ring, two fingerprints that differ
in at most t bits must have a start from which every chain of l consecutive segments,
l = 1 .. m, differs in at most floor(l * t / m) bits.  With m = t + 1 the first segment
of that chain is equal and the first two together differ in at most one bit.  This
bounded prefix is the join key: one side brings its two segments as they are, the other
brings them with each single bit of the second flipped.  The longer chains and then the
whole distance are checked inside the join, and a pair is taken at its first valid start
only, so it comes out once.

Only distinct fingerprints are compared.  Copies, however many, meet as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import free_names, release_memory, ship_package, utf8
from .components import connected_components

BITS = 64
SEED = 42
BLOCK = 1 << 15  # shingles that are hashed at once
START_BIT = 58  # where a join key holds the first segment's number; a key has 64 bits at most


def fingerprint(text: bytes, words_in_shingle: int = 4) -> int:
    """SimHash of a text's word shingles as a signed 64-bit number; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - words_in_shingle + 1)
    ends = ends[min(words_in_shingle, len(words)) - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, last, BLOCK):
        pieces = zip(starts[at : min(at + BLOCK, last)].tolist(), ends[at : at + BLOCK].tolist())
        codes = np.array([hashed(joined[a:b], SEED) for a, b in pieces], np.uint64)
        bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int32)
    return int(np.packbits(ones * 2 > last, bitorder="little").view(np.int64)[0])


def fingerprints(
    docs: DataFrame, words_in_shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, code``: the fingerprint of each whole text."""

    ship_package(docs.sparkSession)

    @F.arrow_udf("long")
    def coded(texts: pa.Array) -> pa.Array:
        codes = pa.array([fingerprint(t.as_py(), words_in_shingle) for t in texts], pa.int64())
        release_memory()
        return codes

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), coded(utf8(F.col(text_col))).alias("code")
    )


def _segments(count: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment; widths differ by one at most."""
    bounds = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def _bits(code: Column, segment: tuple[int, int]) -> Column:
    low, width = segment
    return F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _first_valid_start(difference: Column, segments: list[tuple[int, int]], distance: int) -> Column:
    """The first segment from which all chains keep their budgets; null if there is none."""
    count = len(segments)
    off = [F.bit_count(_bits(difference, s)) for s in segments]
    start = F.lit(None).cast("int")
    for s in reversed(range(count)):
        chain, holds = F.lit(0), F.lit(True)
        for length in range(1, count + 1):
            chain = chain + off[(s + length - 1) % count]
            holds = holds & (chain <= length * distance // count)
        start = F.when(holds, F.lit(s)).otherwise(start)
    return start


def close_codes(codes: DataFrame, distance: int = 4) -> DataFrame:
    """``a, b`` with a < b for all distinct ``code`` values at most ``distance`` bits apart."""
    if not 1 <= distance <= 15:
        raise ValueError("the distance must be 1 to 15 bits")
    segments = _segments(max(distance + 1, 3))
    count = len(segments)
    plain, varied = [], []
    for s in range(count):
        first, second = segments[s], segments[(s + 1) % count]
        high = F.shiftleft(_bits(F.col("code"), first), second[1])
        start = F.lit(s << START_BIT).cast("long")
        key = high.bitwiseOR(_bits(F.col("code"), second)).bitwiseOR(start)
        plain.append(key)
        # The first two segments together may differ in floor(2t / (t + 1)) = 1 bit at most.
        varied.append(key)
        varied += [key.bitwiseXOR(F.lit(1 << k).cast("long")) for k in range(second[1])]
    left = codes.select(F.col("code").alias("a"), F.explode(F.array(*plain)).alias("key"))
    right = codes.select(F.col("code").alias("b"), F.explode(F.array(*varied)).alias("varied"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    start = F.shiftrightunsigned("key", START_BIT)
    valid = (
        (F.col("a") < F.col("b"))
        & (_first_valid_start(difference, segments, distance) == start)
        & (F.bit_count(difference) <= distance)
    )
    return left.join(right, (F.col("key") == F.col("varied")) & valid).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    words_in_shingle: int = 4,
    distance: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id, links`` for every row of ``docs``.

    Documents are linked if their fingerprints differ in ``distance`` bits or fewer;
    ``component_id`` is the smallest id that links reach, the row's own included.
    ``links`` counts the other fingerprints within reach in one step.  Null and empty
    texts have the fingerprint zero.  Rows may repeat; null ids take part and get the
    component of the others, or null.  Other columns are not read.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    rows = written(fingerprints(docs, words_in_shingle, id_col, text_col), f"{folder}/codes")
    classes = written(
        rows.groupBy("code").agg(F.min("doc_id").alias("lowest")), f"{folder}/classes"
    )
    edges = written(close_codes(classes.select("code"), distance), f"{folder}/edges")
    roots = connected_components(edges)
    degree = (
        edges.select(F.explode(F.array("a", "b")).alias("node"))
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("degree"))
    )
    linked = roots.join(degree, "node").join(classes, F.col("node") == F.col("code"))
    merged = linked.groupBy("root").agg(F.min("lowest").alias("merged"))
    linked = linked.join(merged, "root").select("code", "degree", "merged")
    labels = classes.join(linked, "code", "left").select(
        "code",
        F.coalesce("merged", "lowest").alias("component_id"),
        F.coalesce("degree", F.lit(0)).alias("links"),
    )
    # Written, so that the join can split a code that a large part of all rows share.
    labels = written(labels, f"{folder}/labels")
    return rows.join(labels, "code").select(
        "doc_id",
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        "component_id",
        "links",
    )


def drop_near_duplicates(
    docs: DataFrame,
    words_in_shingle: int = 4,
    distance: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Rows that repeat that id all stay: they are one document to this operator.
    """
    (own,) = free_names(docs.columns, "kept_id")
    kept = (
        near_duplicates(docs, words_in_shingle, distance, id_col, text_col)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias(own))
    )
    return docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(own)), "left_semi")
