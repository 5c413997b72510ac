"""Links between similar sets of word n-grams, by PartEnum signatures.

Two sets of sizes r and s have a Jaccard similarity of at least t = p/q only if they differ in
at most ``(r + s) * (q - p) / (q + p)`` elements, and then their sizes are within a factor
of t.  Sizes are cut into bands so that similar sets lie in one band or in two neighbours;
the larger set's band bounds the difference by a number k.

For a band, the domain of elements is hashed into n1 groups of n2 partitions.  Of k
differing elements, some group has at most ``k2 = floor(k / n1)``, so at least n2 - k2 of
its partitions are free of them.  A set's signatures are, for each group and each choice of
n2 - k2 of its partitions, a hash of what the set holds there: sufficiently similar sets
share one.  A set signs for its own band and, if it may be the smaller one of a pair across
bands, for the next.

Signatures only propose.  Links are confirmed by intersecting whole sets, and pairs are kept
few without losing a link that matters:

1. Equal sets are one class, signed once.
2. Each class meets the smallest class of each of its signatures, and the one it shares most
   with is compared.  That joins most groups of near copies with one comparison a class.
3. Where classes of one signature are still apart, those not with the smallest one meet all
   classes of other components.  Sizes and parity bitmaps (two sets differ in at least as many
   elements as their bitmaps in bits) drop pairs inside the join; the others are compared.

So every pair of classes that share a signature is linked, compared, ruled out, or already
in one component, and components are those of the full set of links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import combinations
from math import comb
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import ship_package, utf8
from .components import connected_components

SEED = 42
CHUNK = 1 << 20  # bytes of a text that are cut into words at once
MANY_WORDS = 1 << 18  # distinct words a task remembers the hashes of
BITMAP = 8  # words of 64 bits
PROJECTED = 10  # elements that a signature should cover, as far as a set has them
BATCH_NUMBERS = 1 << 19  # signatures or elements in a batch that leaves a task
#: A table of so many rows at most goes to all tasks; a larger one is shuffled.
SMALL_ROWS = 1_000_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that changes half the bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """The sets of word n-grams of texts, as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = xxhash.xxh3_64_intdigest(word, SEED)
            if len(word) <= 64:
                if len(self.known) >= MANY_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def _word_hashes(self, text: bytes) -> np.ndarray:
        pieces, start = [], 0
        while start < len(text):
            space = _SPACE.search(text, start + CHUNK)
            end = space.start() if space else len(text)
            found = text[start:end].lower().split()
            pieces.append(np.fromiter(map(self._hash, found), np.uint64, len(found)))
            start = end
        return np.concatenate(pieces) if pieces else np.empty(0, np.uint64)

    def of(self, text: bytes) -> np.ndarray:
        hashed = self._word_hashes(text)
        size = min(self.words, len(hashed))
        if not size:
            return hashed
        rows = len(hashed) - size + 1
        total = np.full(rows, size, np.uint64)
        for k in range(size):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + rows])
        return np.unique(total)


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``percent`` in a hundred."""

    percent: int

    def __post_init__(self):
        if not 50 <= self.percent < 100:
            raise ValueError("the similarity must be 50 to 99 percent")

    def differing(self, sizes: int) -> int:
        """The most elements in which two sets of so many elements together may differ."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def bands(self) -> tuple[tuple[int, int], ...]:
        """(smallest, largest) size of each band; a band spans two steps of similar sizes."""
        found, low = [], 1
        while low < 1 << 40:
            high = max(low, low * 10_000 // self.percent**2)
            found.append((low, high))
            low = high + 1
        return tuple(found)

    def linked(self, both: Column, sizes: Column) -> Column:
        return both * (100 + self.percent) >= sizes * self.percent


class PartEnum:
    """Signatures of sets, by band."""

    def __init__(self, similarity: Similarity):
        self.similarity = similarity
        self.bands = similarity.bands()
        self.lows = np.array([low for low, _ in self.bands])
        self.schemes: dict[int, tuple] = {}

    def scheme(self, band: int) -> tuple[int, int, np.ndarray, np.ndarray] | None:
        """Groups, partitions of each, choices of partitions, salts; None if sets must be equal.

        Of all ways that guarantee a shared signature, the one with the fewest signatures
        whose choices cover enough elements of the band's smallest set.
        """
        if band not in self.schemes:
            low, high = self.bands[band]
            most = self.similarity.differing(2 * high)
            self.schemes[band] = self._chosen(band, low, most) if most else None
        return self.schemes[band]

    def _chosen(self, band: int, low: int, most: int) -> tuple:
        ways = []
        for groups in {*range(1, min(most, 64) + 1), *(-(-(most + 1) // k) for k in range(1, 6))}:
            free = most // groups
            for partitions in range(free + 1, free + 6) if free <= 4 else ():
                covered = low * (partitions - free) / (groups * partitions)
                signatures = groups * comb(partitions, free)
                enough = covered >= min(PROJECTED, 0.75 * low)
                ways.append((not enough, signatures if enough else -covered, groups, partitions, free))
        *_, groups, partitions, free = min(ways)
        choices = np.ones((comb(partitions, free), partitions), np.uint64)
        for row, left_out in enumerate(combinations(range(partitions), free)):
            choices[row, [*left_out]] = 0
        numbers = np.arange(groups * len(choices), dtype=np.uint64) + np.uint64(band + 1 << 40)
        return groups, partitions, choices, _mixed(numbers).reshape(groups, -1)

    def _signed(self, hashes: np.ndarray, band: int) -> np.ndarray:
        scheme = self.scheme(band)
        if scheme is None:
            return np.empty(0, np.uint64)
        groups, partitions, choices, salts = scheme
        cells = groups * partitions
        own = _mixed(hashes + np.uint64(band * 0x9E3779B97F4A7C15 % 2**64))
        at = ((own >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        held = np.zeros(cells, np.uint64)
        np.add.at(held, at, _mixed(own))
        return _mixed((held.reshape(groups, partitions) @ choices.T) ^ salts).ravel()

    def signatures(self, hashes: np.ndarray) -> np.ndarray:
        size = len(hashes)
        if not size:
            return np.empty(0, np.uint64)
        band = int(np.searchsorted(self.lows, size, "right")) - 1
        own = self._signed(hashes, band)
        if 100 * size < self.similarity.percent * self.bands[band + 1][0]:
            return own
        return np.concatenate([own, self._signed(hashes, band + 1)])


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """A bit for each hash bucket: whether it holds an odd number of elements."""
    bucket = (hashes & np.uint64(64 * BITMAP - 1)).astype(np.int64)
    odd = (np.bincount(bucket, minlength=64 * BITMAP) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


@lru_cache(maxsize=4)
def _tools(words: int, percent: int) -> tuple[Shingles, PartEnum]:
    return Shingles(words), PartEnum(Similarity(percent))


def _key(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes(), SEED) if len(hashes) else None


def _long_lists(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    values = np.concatenate([*lists, np.empty(0, np.uint64)]).astype(np.uint64).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


BITS = [f"bits{k}" for k in range(BITMAP)]


def _signed_rows(
    batches: Iterator[pa.RecordBatch], words: int, percent: int
) -> Iterator[pa.RecordBatch]:
    """A row for each text: a number of its own, its set's key, size, bitmap and signatures."""
    shingles, scheme = _tools(words, percent)
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, texts = batch.columns
        rows, numbers, first = [], 0, 0
        for at, text in enumerate(texts):
            hashes = shingles.of(text.as_py())
            signatures = scheme.signatures(hashes)
            rows.append((_key(hashes), len(hashes), bitmap(hashes), signatures))
            numbers += len(signatures)
            if numbers >= BATCH_NUMBERS or at + 1 == len(texts):
                keys, sizes, bits, signed = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(rows)),
                        pa.array(range(number, number + len(rows)), pa.int64()),
                        pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                        *(pa.array(column) for column in np.array(bits).T), _long_lists(signed),
                    ],
                    names=["doc_id", "row", "set_key", "size", *BITS, "signatures"],
                )
                number += len(rows)
                first, rows, numbers = at + 1, [], 0


def _set_rows(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The whole set of each text, with its key."""
    shingles, _ = _tools(words, percent)

    def packed(rows: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([_key(h) for h in rows], pa.binary()), _long_lists(rows)], names=["set_key", "elements"]
        )

    for batch in batches:
        rows, numbers = [], 0
        for text in batch.column(0):
            hashes = shingles.of(text.as_py())
            rows.append(hashes)
            numbers += len(hashes)
            if numbers >= BATCH_NUMBERS:
                yield packed(rows)
                rows, numbers = [], 0
        if rows:
            yield packed(rows)


def _sized(df: DataFrame) -> DataFrame:
    """A written table, marked for all tasks if it is small; else Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def similar_documents(
    docs: DataFrame,
    words_in_shingle: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A text's set are its distinct shingles of ``words_in_shingle`` words, A-Z in lower case;
    with fewer words, all of them as one.  Rows are linked if the Jaccard similarity of
    their sets is ``percent`` in a hundred or more, and ``component_id`` is the smallest id
    that links reach, the row's own included.  Texts without a word, and null, have no
    shingle and no link.  Rows may repeat: equal sets are linked, whatever their ids.  Null
    ids take part and get the component of the others, or null.  Texts of any length are
    read whole.  An empty table gives no rows; other columns are not read.

    Elements are compared as 64-bit hashes and sets known by 128 bits.  Two different
    elements of one pair of sets take part as equal with a chance of about one in 2^64.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = scratch_folder(spark)
    similarity = Similarity(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    columns = "doc_id long, row long, set_key binary, size long, "
    columns += ", ".join(f"{name} long" for name in BITS) + ", signatures array<long>"
    rows = written(
        texts.mapInArrow(lambda b: _signed_rows(b, words_in_shingle, percent), columns), f"{folder}/rows"
    )
    classes = rows.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("lowest")
    )
    classes = written(classes, f"{folder}/classes")

    met = _meetings(rows, classes, folder)
    members = _members(rows, classes, met, folder)
    sets = _whole_sets(texts, members, words_in_shingle, percent, folder)

    near = _linked(_best_pairs(met), sets, similarity, f"{folder}/near")
    found = written(connected_components(near), f"{folder}/found")
    apart = _linked(_pairs_apart(met, members, found, similarity, folder), sets, similarity, f"{folder}/apart")
    roots = connected_components(written(near.union(apart), f"{folder}/links"))
    return _labelled(rows, classes, roots, folder)


def _meetings(rows: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """``signature, node, pivot``: classes whose signature is not theirs alone, and its smallest."""
    own = _sized(classes.select("node"))
    signed = rows.join(own, F.col("row") == F.col("node"), "left_semi").select(
        F.col("row").alias("node"), F.explode("signatures").alias("signature")
    )
    shared = signed.groupBy("signature").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
    shared = written(shared.filter("pivot < last").drop("last"), f"{folder}/shared")
    return written(signed.join(_sized(shared), "signature"), f"{folder}/met")


def _members(rows: DataFrame, classes: DataFrame, met: DataFrame, folder: str) -> DataFrame:
    """``node, lowest, set_key, size, bits...`` of the classes that meet another one."""
    meeting = written(met.select("node").distinct(), f"{folder}/meeting")
    some = classes.join(_sized(meeting), "node", "left_semi")
    some = written(some, f"{folder}/some")
    own = rows.select(F.col("row").alias("node"), "size", *BITS)
    return written(own.join(_sized(some), "node"), f"{folder}/members")


def _whole_sets(
    texts: DataFrame, members: DataFrame, words: int, percent: int, folder: str
) -> DataFrame:
    """``node, elements``: the sets of the classes that meet others, read again from one text each."""
    wanted = _sized(members.select(F.col("lowest").alias("wanted")).distinct())
    some = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    found = some.select("text").mapInArrow(
        lambda b: _set_rows(b, words, percent), "set_key binary, elements array<long>"
    )
    found = found.join(_sized(members.select("set_key", "node")), "set_key").select("node", "elements")
    # Rows that repeat a text of one id bring its set more than once.
    return written(found.dropDuplicates(["node"]), f"{folder}/sets")


def _best_pairs(met: DataFrame) -> DataFrame:
    """``a, b``: each class with the pivot that it shares the most signatures with."""
    counted = met.filter("node <> pivot").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("shared"))
    best = F.max(F.struct(F.col("shared"), (-F.col("pivot")).alias("low"))).alias("best")
    return counted.groupBy("node").agg(best).select(
        (-F.col("best.low")).alias("a"), F.col("node").alias("b")
    )


def _linked(pairs: DataFrame, sets: DataFrame, similarity: Similarity, path: str) -> DataFrame:
    """The pairs whose whole sets are similar."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("elements").alias(f"of_{name}"))

    pairs = written(pairs, f"{path}-pairs")
    compared = pairs.join(side("a"), "a").join(side("b"), "b")
    both = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    sizes = (F.size("of_a") + F.size("of_b")).cast("long")
    return written(compared.filter(similarity.linked(both, sizes)).select("a", "b"), path)


def _pairs_apart(
    met: DataFrame, members: DataFrame, found: DataFrame, similarity: Similarity, folder: str
) -> DataFrame:
    """``a, b``: pairs that share a signature, are not connected, and are not ruled out."""
    placed = members.join(_sized(found), "node", "left").select(
        "node", F.coalesce("root", "node").alias("component"), "size", *BITS
    )
    placed = written(placed, f"{folder}/placed")
    home = _sized(placed.select(F.col("node").alias("pivot"), F.col("component").alias("home")))
    sharing = written(met.join(_sized(placed), "node").join(home, "pivot"), f"{folder}/sharing")
    away = sharing.filter("component <> home").select(
        "signature", *(F.col(c).alias(f"own_{c}") for c in ("node", "component", "size", *BITS))
    )
    size, own_size = F.col("size"), F.col("own_size")
    least, most = F.least(size, own_size), F.greatest(size, own_size)
    bits = reduce(add, (F.bit_count(F.col(b).bitwiseXOR(F.col(f"own_{b}"))) for b in BITS))
    budget = (size + own_size) * (100 - similarity.percent)
    possible = (
        (F.col("component") != F.col("own_component"))
        & ((F.col("component") == F.col("home")) | (F.col("own_node") < F.col("node")))
        & (least * 100 >= most * similarity.percent)
        & (bits * (100 + similarity.percent) <= budget)
    )
    return (
        away.join(sharing, (away["signature"] == sharing["signature"]) & possible)
        .select(F.least("own_node", "node").alias("a"), F.greatest("own_node", "node").alias("b"))
        .distinct()
    )


def _labelled(rows: DataFrame, classes: DataFrame, roots: DataFrame, folder: str) -> DataFrame:
    """Components back to rows; tables are written where a join may have to split a hot key."""
    roots = written(roots, f"{folder}/roots")
    joined = written(classes.join(roots, "node"), f"{folder}/joined")
    merged = written(joined.groupBy("root").agg(F.min("lowest").alias("merged")), f"{folder}/merged")
    others = joined.join(merged, "root").select("set_key", "merged")
    labels = classes.join(written(others, f"{folder}/others"), "set_key", "left").select(
        "set_key", F.coalesce("merged", "lowest").alias("component_id")
    )
    labels = written(labels, f"{folder}/labels")
    return rows.select("doc_id", "set_key", F.col("size").alias("n_shingles")).join(
        labels, "set_key", "left"
    ).select(
        "doc_id", "n_shingles",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
