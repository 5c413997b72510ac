"""Benchmark decontamination by latent semantic retrieval.

1. Words are counted by document over all documents.  The vocabulary has those of the
   benchmark and the most frequent others.
2. A randomised SVD of the TF-IDF matrix (benchmark items and all windows of all documents
   as rows) gives a latent space.  Passages stay on the executors: a block of directions is
   multiplied by the matrix and back, word by word sums are added up in a shuffle, and only
   the words x rank block comes to the driver.
3. Every document is cut into overlapping windows, the windows are folded into the space
   and compared with all items by cosine.  Frequent words take part, weighed down by their
   idf: a paraphrase that replaces the rare words of an item keeps only these.  A long item is folded as overlapping passages,
   as long as a window each; a short one is looked up by its rarest words, one of which
   every leak must hold.
4. Each candidate is verified: the longest common subsequence of words between item and
   the text around the window must hold enough of the item, and enough of its answer.

Items are held in blocks of ``ITEMS_AT_ONCE``; documents are scanned once for each block.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import free_names, map_batches, ship_package

RANK, EXTRA, ROUNDS = 96, 8, 3
FULL_ROUNDS = 0  # rounds over all windows of all documents; more found no more of the planted leaks
HALF = 16  # words; a window is two halves, and windows start at every half
CORPUS_WEIGHT = 400  # in the SVD all documents together weigh as much as so many would
COMMON_WORDS = 1 << 13  # bound of the vocabulary beyond the words of a block of items
ITEMS_AT_ONCE = 4000
ITEM_WEIGHT = 4.0
WHOLE = 4 * HALF  # words of the longest item that is folded whole
BLOCK = 16 * HALF  # words whose surroundings are tested at once for the words of an item
COSINE, COVERED = 0.3, 0.2
SHORT = 24  # items with fewer words are looked up by their rarest words: windows around them are mostly other words
ENOUGH, CLEAR, ANSWER = 0.6, 0.8, 0.5
WORDS_AT_ONCE, TEXTS_AT_ONCE = 16_000, 256
PRODUCT_WORDS = 1 << 16  # words whose windows are multiplied at once, a multiple of HALF
TEXTS_COUNTED = 1024  # texts whose words are counted at once

#: Signs and controls of ASCII as spaces, upper-case letters as lower-case ones.
FOLD = bytes(
    b + 32 if 65 <= b < 91 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case, without ASCII signs.  Other letters are folded by the caller."""
    return text.translate(FOLD).split()


def folded(texts: pa.Array) -> list[bytes | None]:
    return pc.cast(pc.utf8_lower(texts), pa.binary()).to_pylist()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as ``words_of`` their folded bytes, and how many each text has."""
    lower = pc.cast(pc.fill_null(pc.utf8_lower(texts), ""), pa.large_binary())
    _, offsets, data = lower.buffers()
    data = pa.py_buffer((data.to_pybytes() if data else b"").translate(FOLD))
    spaced = pa.Array.from_buffers(pa.large_string(), len(lower), [None, offsets, data], offset=lower.offset)
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(spaced))
    words, sizes = split.flatten(), np.diff(split.offsets.to_numpy())
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not some.all():  # a text without a word has an empty one
        text = np.repeat(np.arange(len(sizes)), sizes)
        words, sizes = words.filter(pa.array(some)), np.bincount(text[some], minlength=len(sizes))
    return words, sizes


def placed(texts: pa.Array, known: pa.Array) -> list[np.ndarray]:
    """Texts as the places of their words in ``known``, counted from 1; 0 is for all others."""
    words, sizes = split_words(texts)
    places = pc.fill_null(pc.add(pc.index_in(words, known), 1), 0).to_numpy(zero_copy_only=False)
    return np.split(places, np.cumsum(sizes)[:-1])


def vocabulary_of(slots: dict[bytes, int]) -> pa.Array:
    return pa.array(slots, pa.binary()).cast(pa.large_binary()).view(pa.large_string())


def answer_of(text: str) -> str:
    """The closing sentence of an item, which stands for its answer where none is given."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n+", text.strip()) if p.strip()]
    return parts[-1] if parts else ""


def common_length(item: list, text: list) -> int:
    """Length of a longest common subsequence of words, a bit for each word of ``item``."""
    places: dict[object, int] = {}
    for k, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << k
    every = (1 << len(item)) - 1
    row = every
    for word in text:
        if match := places.get(word):
            hit = row & match
            row = ((row + hit) | (row - hit)) & every
    return len(item) - row.bit_count()


def common_words(item: list, text: list) -> list[bool]:
    """Which words of ``item`` are in a longest common subsequence with ``text``."""
    places: dict[object, int] = {}
    for k, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << k
    every = (1 << len(item)) - 1
    rows = [every]  # a clear bit: this word of the item lengthens the subsequence
    for word in text:
        row = rows[-1]
        hit = row & places.get(word, 0)
        rows.append(((row + hit) | (row - hit)) & every)
    taken, i, j = [False] * len(item), len(item), len(text)
    while i and j:
        if item[i - 1] == text[j - 1]:
            taken[i - 1], i, j = True, i - 1, j - 1
        elif rows[j] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return taken


def passages(words: list[bytes]) -> list[tuple[int, list[bytes]]]:
    """(first word, words) of what an item is folded as; together they hold all its words."""
    if len(words) <= WHOLE:
        return [(0, words)]
    return [(at, words[at : at + 2 * HALF]) for at in range(0, len(words) - HALF, HALF)]


@dataclass(frozen=True)
class Item:
    key: object
    words: list[bytes]
    answer: int  # number of closing words that are the answer


@dataclass(frozen=True)
class Retriever:
    """A latent space, and a block of items in it."""

    slots: dict[bytes, int]  # place of a word in ``basis``; 0 is for all other words
    basis: np.ndarray  # words x rank, each row times the word's idf
    items: list[Item]
    parts: list[tuple[int, int]]  # (item, first word) of each passage, by item
    folded: np.ndarray  # passages x rank
    rarest: dict[bytes, list[int]]  # passages of short items, by words
    cosine: float = COSINE
    covered: float = COVERED

    def candidates(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int, int, float]]:
        """(text, item, first word of window, cosine) of the windows that look like an item."""
        place, unknown = self.slots.get, repeat(0)
        places = [np.array(list(map(place, words, unknown)), np.int32) for words in texts]
        for text, passage, at, cosine in self.matches(places):
            yield text, self.parts[passage][0], at, cosine

    @cached_property
    def _words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the words of all items, where each item's begin, and how many it has."""
        sizes = np.array([len(item.words) for item in self.items])
        places = np.array([self.slots[w] for item in self.items for w in item.words], np.intp)
        return places, np.cumsum(sizes) - sizes, sizes

    def _held(self, places: np.ndarray) -> np.ndarray:
        """For each item: do these words hold enough of it?

        A longest common subsequence is no longer than that, so nothing is lost.
        """
        words, begins, sizes = self._words
        here = np.zeros(len(self.basis), bool)
        here[places] = True
        return np.add.reduceat(here.take(words), begins, dtype=np.int32) >= ENOUGH * sizes

    def _held_around(self, places: list[np.ndarray], part: list[tuple[int, int, int]]) -> list[np.ndarray]:
        """For each stretch, its blocks of words by items: may an item be around a window in there?

        The text around a window is what a candidate is verified on.  For an item of more
        than ``WHOLE`` words all of the text is looked at.
        """
        long = self._words[2] > WHOLE
        around = []
        for text, start, stop in part:
            own, begins = places[text], range(start, max(stop, start + 1), BLOCK)
            held = np.array([
                self._held(own[max(0, at - WHOLE) : at + BLOCK + WHOLE + 2 * HALF]) for at in begins
            ])
            if long.any():
                held[:, long] = self._held(own)[long]
            around.append(held)
        return around

    def matches(self, places: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """(text, passage, first word of window, cosine) of the windows that look like a passage.

        Windows without enough of an item's words around them are left out.
        """
        norms = np.linalg.norm(self.folded, axis=1)
        units = (self.folded / np.where(norms > 0, norms, 1)[:, None]).T
        item_of = np.array([k for k, _ in self.parts])
        for part in _parts(places):
            around = self._held_around(places, part)
            yield from self._looked_up(places, part, around)
            # Each text begins a half of its own, with an empty half behind it.
            halves = np.array([-(-(stop - start) // HALF) + 1 for _, start, stop in part])
            first = np.concatenate([[0], np.cumsum(halves)])
            stretch = np.repeat(np.arange(len(part)), halves)
            begins = (np.arange(first[-1]) - first[stretch]) * HALF
            blocks, held = np.array([len(h) for h in around]), np.concatenate(around)
            block = (np.cumsum(blocks) - blocks)[stretch] + np.minimum(begins // BLOCK, blocks[stretch] - 1)
            some = np.flatnonzero(held.any(1)[block])  # no item is around the other windows
            slots = np.zeros((first[-1] + 1, HALF), np.int32)
            for (text, start, stop), half in zip(part, first):
                slots[half:].reshape(-1)[: stop - start] = places[text][start:stop]
            wanted = np.union1d(some, some + 1)
            sums = _half_sums(slots[wanted], self.basis)
            windows = sums[np.searchsorted(wanted, some)] + sums[np.searchsorted(wanted, some + 1)]
            size = np.linalg.norm(windows, axis=1)
            full = size > 0
            some, windows, size = some[full], windows[full], size[full]
            cosine = (windows / size[:, None]) @ units
            row, passage = np.nonzero(cosine >= self.cosine)
            keep = held[block[some[row]], item_of[passage]]
            row, passage = row[keep], passage[keep]
            near, length = cosine[row, passage], size[row]
            keep = (norms[passage] > 0) & (near * length >= self.covered * norms[passage])
            row, passage, near = row[keep], passage[keep], near[keep]
            begun = some[row]
            for k, at, own, cos in zip(stretch[begun].tolist(), begins[begun].tolist(), passage.tolist(), near.tolist()):
                text, start, _ = part[k]
                yield text, own, start + at, cos

    def _looked_up(
        self, places: list[np.ndarray], part: list[tuple[int, int, int]], around: list[np.ndarray]
    ) -> Iterator[tuple[int, int, int, float]]:
        """The windows with one of the rarest words of a short item, where enough of its words are around."""
        rare = self._rare_places
        short = np.array([*rare], np.int64)
        items = [self.parts[passage][0] for passage in rare]
        wanted = np.zeros(len(self.basis), bool)
        for (text, start, stop), held in zip(part, around):
            for block, which in zip(*np.nonzero(held[:, items])):
                passage, low = int(short[which]), start + int(block) * BLOCK
                own = places[text][low : min(stop, low + BLOCK)]
                wanted[rare[passage]] = True
                hits = np.flatnonzero(wanted[own])
                wanted[rare[passage]] = False
                for half in sorted(set((hits // HALF).tolist())):
                    at = low + half * HALF
                    total = self.basis[places[text][at : at + 2 * HALF]].sum(0)
                    size = np.linalg.norm(total) * np.linalg.norm(self.folded[passage])
                    yield text, passage, at, float(total @ self.folded[passage] / size) if size else 0.0

    @cached_property
    def _rare_places(self) -> dict[int, list[int]]:
        """Places of the rarest words of each short item, by its passage."""
        rare: dict[int, list[int]] = {}
        for word, its in self.rarest.items():
            for passage in its:
                rare.setdefault(passage, []).append(self.slots[word])
        return dict(sorted(rare.items()))

    @cached_property
    def _item_places(self) -> list[list[int]]:
        return [[self.slots[w] for w in item.words] for item in self.items]

    def leaks(self, texts: list[np.ndarray]) -> Iterator[tuple]:
        """(text, item, cosine, share of its words, share of its answer, place) of confirmed items."""
        best: dict[tuple[int, int], tuple] = {}
        tried: set[tuple[int, int, int]] = set()
        for k, passage, at, cosine in self.matches(texts):
            i, offset = self.parts[passage]
            item = self.items[i]
            wanted, found = len(item.words), best.get((k, i))
            if found and found[3] >= 1:
                continue
            low, high = at - wanted, at + 2 * HALF + wanted
            if wanted > WHOLE:
                # Passages that agree on where the item begins are verified once.
                step = wanted // 8
                begin = (at - offset) // step
                if (k, i, begin) in tried:
                    continue
                tried.add((k, i, begin))
                low = begin * step - wanted // 2
                high = (begin + 1) * step + 2 * HALF + wanted + wanted // 2
            own, text = self._item_places[i], texts[k][max(0, low) : max(0, high)].tolist()
            here = set(text)
            if sum(map(here.__contains__, own)) < ENOUGH * wanted:
                continue  # more words than these cannot be in a common subsequence
            share = common_length(own, text) / wanted
            if share < ENOUGH or (found and share <= found[3]):
                continue
            answer = sum(common_words(own, text)[-item.answer :]) / item.answer
            if share >= CLEAR or answer >= ANSWER:
                best[k, i] = (k, item.key, cosine, share, answer, at)
        yield from best.values()


def _parts(texts: list[np.ndarray]) -> Iterator[list[tuple[int, int, int]]]:
    """(text, first word, end) of stretches, gathered until there are enough words.

    A stretch of a very long text overlaps the next one by a half.
    """
    part, size = [], 0
    for k, words in enumerate(texts):
        for start in range(0, max(len(words), 1), WORDS_AT_ONCE):
            stop = min(len(words), start + WORDS_AT_ONCE + HALF)
            part.append((k, start, stop))
            size += stop - start
            if size >= WORDS_AT_ONCE:
                yield part
                part, size = [], 0
    if part:
        yield part


def _half_sums(slots: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sum of the words' vectors for each half, a row of places."""
    sums = np.zeros((len(slots), basis.shape[1]), np.float32)
    for column in np.sort(slots, axis=1).T:  # unknown words, which add nothing, to the left
        rows = np.flatnonzero(column)
        if 2 * len(rows) < len(column):
            sums[rows] += basis[column[rows]]
        else:
            sums += basis.take(column, axis=0)
    return sums


# -- the latent space ----------------------------------------------------------


def _counted_words(texts: DataFrame) -> DataFrame:
    """``word, docs``: the number of documents that hold each word, over all of ``texts``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), TEXTS_COUNTED):
                words, sizes = split_words(batch.column(0).slice(at, TEXTS_COUNTED))
                words = words.dictionary_encode()
                known = len(words.dictionary)
                pairs = np.repeat(np.arange(len(sizes)), sizes) * known + words.indices.to_numpy()
                pairs.sort()
                once = pairs[np.diff(pairs, prepend=-1) > 0] % max(known, 1)
                docs = np.bincount(once, minlength=known)
                own = words.dictionary.cast(pa.large_binary()).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([own, pa.array(docs, pa.int64())], ["word", "docs"])

    counts = map_batches(texts, counted, "word binary, docs long")
    return counts.groupBy("word").agg(F.sum("docs").alias("docs"))


def _vocabulary(items: list[Item], counted: DataFrame) -> tuple[list[bytes], dict[bytes, int]]:
    """Words of the items, then the others by documents, up to a bound; and their documents."""
    ours = sorted({w for item in items for w in item.words})
    own = counted.sparkSession.createDataFrame(pa.table({"word": pa.array(ours, pa.binary())}))
    held = counted.join(F.broadcast(own), "word").collect()
    often = counted.orderBy(F.desc("docs"), "word").limit(COMMON_WORDS).collect()
    frequency = {w: 0 for w in ours} | {bytes(r["word"]): r["docs"] for r in (*held, *often)}
    return list(frequency), frequency


def _in_halves(places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of half a window, two at least for each, and the rows at which windows begin.

    ``places`` are words by their place; a window is the row where it begins and the next.
    """
    sizes = np.array([len(own) for own in places])
    halves = np.maximum(-(-sizes // HALF), 2)
    first = np.cumsum(halves) - halves
    rows = np.zeros((halves.sum(), HALF), np.int32)
    shift = first * HALF - (np.cumsum(sizes) - sizes)
    rows.reshape(-1)[np.arange(sizes.sum()) + np.repeat(shift, sizes)] = np.concatenate(places)
    last = np.zeros(len(rows), bool)
    last[first + halves - 1] = True
    return rows, np.flatnonzero(~last)


def _add_product(
    sums: np.ndarray, places: list[np.ndarray], scales: list[float], idf: np.ndarray, base: np.ndarray
) -> None:
    """Add A'(A V) for the windows of some texts to ``sums`` (words x rank), but for the left idf.

    ``base`` is V, each row times its word's idf.  Windows have length ``scales``, by text.
    """
    rows, begins = _in_halves(places)
    counts = [max(-(-len(own) // HALF), 2) - 1 for own in places]
    squares = np.repeat(np.square(np.array(scales, np.float64)), counts)
    # The squared length of a window: a word that is there n times has n * idf.
    bags = np.sort(np.concatenate([rows[begins], rows[begins + 1]], axis=1), axis=1).T
    length, times, before = np.zeros(len(begins)), np.zeros(len(begins), np.int32), None
    for column in bags:
        times = times + 1 if before is None else np.where(column == before, times + 1, 1)
        length += (2 * times - 1) * np.square(idf[column])
        before = column
    halves = _half_sums(rows, base)
    scale = np.divide(squares, length, out=np.zeros(len(begins)), where=length > 0)
    out = (halves[begins] + halves[begins + 1]) * scale[:, None].astype(np.float32)
    back = np.zeros_like(halves)
    back[begins] += out
    back[begins + 1] += out
    flat = rows.reshape(-1)
    known = np.flatnonzero(flat)
    slot, half = flat[known].astype(np.intp), known // HALF
    for k, column in enumerate(back.T.astype(np.float64, order="C")):
        sums[k] += np.bincount(slot, column.take(half), sums.shape[1])


def randomised_svd(
    passages: DataFrame,
    slots: dict[bytes, int],
    idf: np.ndarray,
    rank: int = RANK,
    rounds: int = ROUNDS,
) -> np.ndarray:
    """The leading right singular vectors (words x rank) of the passages' TF-IDF matrix.

    ``passages(text, weight)``: each text is cut into windows, whose rows are scaled by
    ``weight``.  Rows are never collected: with a block V, tasks compute A'(A V) for their
    windows, and a shuffle adds the parts up by word.  A random block is multiplied and
    orthogonalised in each round.  The vectors are those of the Nystrom approximation
    A'A = Y (V'Y)^-1 Y' from one more product Y.
    """
    spark = passages.sparkSession
    width = min(rank + EXTRA, len(idf))
    block = np.random.default_rng(11).standard_normal((len(idf), width), np.float32)
    block = np.linalg.qr(block)[0]

    def product(v: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((vocabulary_of(slots), idf, (v * idf[:, None]).astype(np.float32)))

        def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, weight_of, base = shared.value
            sums = np.zeros(base.shape[::-1])
            for batch in batches:
                places, scales, size = [], [], 0
                for at in range(0, len(batch), TEXTS_AT_ONCE):
                    texts = placed(batch.column(0).slice(at, TEXTS_AT_ONCE), known)
                    for own, scale in zip(texts, batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()):
                        for start in range(0, max(len(own) - HALF, 1), PRODUCT_WORDS):
                            # A stretch of a very long text overlaps the next one by a half.
                            places.append(own[start : start + PRODUCT_WORDS + HALF])
                            scales.append(scale)
                            size += len(places[-1])
                            if size >= PRODUCT_WORDS:
                                _add_product(sums, places, scales, weight_of, base)
                                places, scales, size = [], [], 0
                if places:
                    _add_product(sums, places, scales, weight_of, base)
            vectors = sums.T * weight_of[:, None]
            keys = np.flatnonzero(vectors.any(1))
            vectors = [x.tobytes() for x in vectors[keys].astype(np.float32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(vectors, pa.binary())], ["slot", "vector"]
            )

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for s, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    x = np.frombuffer(vector, np.float32).astype(np.float64)
                    if s in sums:
                        sums[s] += x
                    else:
                        sums[s] = x
            keys = sorted(sums)
            vectors = [sums[s].astype(np.float32).tobytes() for s in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(vectors, pa.binary())], ["slot", "vector"]
            )

        parts = map_batches(passages, multiplied, "slot long, vector binary").repartition("slot")
        result = np.zeros_like(v)
        for row in map_batches(parts, added, "slot long, vector binary").collect():
            result[row["slot"]] = np.frombuffer(row["vector"], np.float32)
        shared.destroy()
        return result

    for _ in range(rounds):
        block = np.linalg.qr(product(block))[0].astype(np.float32)
    last = product(block).astype(np.float64)
    small = block.T @ last
    values, turn = np.linalg.eigh((small + small.T) / 2)
    known = values > 1e-6 * values[-1]
    vectors, _, _ = np.linalg.svd(last @ (turn[:, known] / np.sqrt(values[known])), full_matrices=False)
    return vectors[:, :rank].astype(np.float32)


def _items(rows: list, answer_col: str | None) -> list[Item]:
    items = []
    for row in rows:
        text = row["text"] or ""
        words = words_of(text.lower().encode())
        answer = row["answer"] if answer_col else answer_of(text)
        if words:
            count = len(words_of((answer or "").lower().encode()))
            items.append(Item(row["key"], words, min(max(count, 1), len(words))))
    return items


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
) -> DataFrame:
    """``doc_id, item_id, cosine, shared, answer, place``: items that a document holds.

    ``shared`` is the part of the item's words in the longest common subsequence,
    ``answer`` that of its closing words (or of ``answer_col``, as many closing words),
    ``place`` the window's first word.  Null and empty texts and items without a word
    leak nothing; empty tables give no rows.  Repeated rows and items are found each.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    answer = F.col(answer_col) if answer_col else F.lit(None)
    wanted = benchmark.select(
        F.col(item_col).cast("long").alias("key"),
        F.col(item_text_col).alias("text"),
        answer.cast("string").alias("answer"),
    )
    weight = math.sqrt(min(1.0, CORPUS_WEIGHT / max(docs.count(), 1)))
    passages = docs.select(text, F.lit(weight).alias("weight"))
    found = counted = None
    for rows in _blocks(wanted):
        items = _items(rows, answer_col)
        if not items:
            continue
        if counted is None:
            counted = written(_counted_words(docs.select(text)), f"{scratch_folder(spark)}/words")
        retriever = _retriever(items, docs.select(text), passages, counted)
        some = _search(docs.select(F.col(id_col).cast("long").alias("doc_id"), text), retriever)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return spark.createDataFrame([], LEAKS)
    return found


LEAKS = "doc_id long, item_id long, cosine double, shared double, answer double, place long"


def _blocks(wanted: DataFrame) -> Iterator[list]:
    """The stated query set in blocks that the driver can hold."""
    count = wanted.count()
    parts = max(1, -(-count // ITEMS_AT_ONCE))
    block = F.pmod(F.xxhash64("key", "text"), F.lit(parts))
    for k in range(parts):
        yield wanted.filter(block == k).orderBy("key", "text").collect()


def _retriever(
    items: list[Item], texts: DataFrame, documents: DataFrame, counted: DataFrame | None = None
) -> Retriever:
    """The space of ``documents(text, weight)`` and the items; idf is that over ``texts``.

    ``counted`` are the written counts of the texts' words, if they are there already.
    """
    spark = texts.sparkSession
    if counted is None:
        counted = written(_counted_words(texts), f"{scratch_folder(spark)}/words")
    words, frequency = _vocabulary(items, counted)
    slots = {w: k for k, w in enumerate(words, 1)}
    idf = np.zeros(len(words) + 1, np.float32)
    idf[1:] = np.log((1 + texts.count()) / (1 + np.array([frequency[w] for w in words]))) + 1
    rows = [b" ".join(item.words).decode("utf-8", "replace") for item in items]
    # As Arrow: rows of Python would need Python workers of their own, which stay.
    own = spark.createDataFrame(pa.table({"text": rows, "weight": [ITEM_WEIGHT] * len(rows)}))
    basis = randomised_svd(documents.unionByName(own), slots, idf, rounds=FULL_ROUNDS)
    basis = (basis * idf[:, None]).astype(np.float32)
    parts = [(k, at, part) for k, item in enumerate(items) for at, part in passages(item.words)]
    folded_parts = np.stack([
        basis[[slots.get(w, 0) for w in part]].sum(0) for _, _, part in parts
    ])
    rarest: dict[bytes, list[int]] = {}
    for passage, (k, _, part) in enumerate(parts):
        if len(items[k].words) < SHORT:
            # A leak lacks fewer of the item's words than are taken here.
            count = len(part) - math.ceil(ENOUGH * len(part)) + 1
            for w in set(sorted(part, key=lambda w: (frequency[w], w))[:count]):
                rarest.setdefault(w, []).append(passage)
    return Retriever(slots, basis, items, [(k, at) for k, at, _ in parts], folded_parts, rarest)


def _search(rows: DataFrame, retriever: Retriever) -> DataFrame:
    vocabulary = vocabulary_of(retriever.slots)
    shared = rows.sparkSession.sparkContext.broadcast((retriever, vocabulary))  # bounded by its parameters

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, places = shared.value
        for batch in batches:
            out, keys = [], batch.column(0).to_pylist()
            for at in range(0, len(keys), TEXTS_AT_ONCE):
                texts = placed(batch.column(1).slice(at, TEXTS_AT_ONCE), places)
                out += [(keys[at + k], *leak) for k, *leak in known.leaks(texts)]
            if out:
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                names = [part.split()[0] for part in LEAKS.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names
                )

    return map_batches(rows, searched, LEAKS)


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    **columns: str,
) -> DataFrame:
    """The documents that hold no item, with all their columns.

    Documents are matched by id, so rows that share an id go together; a null id matches
    a null id.
    """
    leaks = find_leaks(docs, benchmark, id_col, text_col, **columns)
    (leak,) = free_names(docs.columns, "leak_id")
    ids = leaks.select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(ids, F.col(id_col).cast("long").eqNullSafe(F.col(leak)), "left_anti")
