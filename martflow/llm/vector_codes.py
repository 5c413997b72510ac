"""Compression of vectors to codes, by exact integer k-means with adaptive distance bounds.

Components become integers, vectors are cut into parts, and each part position has a
codebook that is refined by rounds of assignment and averaging.  Distances, sums and
averages are whole numbers, so the result does not depend on how rows are dealt to tasks.

Assignment keeps what it has learned (Drake and Hamerly): with each part of each vector it
stores the assigned entry with an upper bound of its distance, the ``b`` entries that come
next with a lower bound each, in order, and one outer bound for all the others.  When
entries move, bounds move by as much.  A part whose upper bound is below all lower ones
keeps its entry without a distance being computed; otherwise only the entries up to the
first bound that settles the matter are compared.  ``b`` of a part position becomes the
deepest bound that any vector needed.  Bounds are floating-point numbers rounded outwards;
whatever they leave open is decided by integer distances, ties to the lower index.

A round is one pass over a written table: rows carry their bounds with them and are never
shuffled.  Only the movement of the entries goes to the tasks, and only sums by entry come
back; both have parts x entries x components numbers at any number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import ship_package

WIDER = 1e-12  # by how much a bound is moved outwards, relative to its size
SLICE = 4096  # rows whose distances are computed at once

#: Columns of a round's table besides those of the vector: packed numbers, one value a row.
STATE = "cells binary, bounds binary, assigned binary, error long"


def _up(value: np.ndarray) -> np.ndarray:
    return value * (1 + WIDER)


def _down(value: np.ndarray) -> np.ndarray:
    return np.where(value > 0, value * (1 - WIDER), value * (1 + WIDER))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    difference = points[:, None, :] - entries[None, :, :]
    return np.einsum("nkd,nkd->nk", difference, difference)


@dataclass
class Bounds:
    """What a part of each of some rows knows about its distances.

    ``depth`` says how many bounds the last round needed; one more than there are where
    the outer one did not do either and all entries were compared.
    """

    assigned: np.ndarray  # rows
    upper: np.ndarray  # rows
    near: np.ndarray  # rows x b
    lower: np.ndarray  # rows x b
    outer: np.ndarray  # rows
    depth: np.ndarray = field(default=None)
    compared: int = 0


def compared_with_all(points: np.ndarray, entries: np.ndarray, keep: int) -> Bounds:
    """Assignment by comparing every entry."""
    found = squared(points, entries)
    order = np.argsort(found, axis=1, kind="stable").astype(np.int32)
    near = np.sqrt(np.take_along_axis(found, order, 1).astype(np.float64))
    keep = min(keep, len(entries) - 1)
    rest = near[:, keep + 1] if keep + 1 < len(entries) else np.full(len(points), np.inf)
    return Bounds(
        order[:, 0], _up(near[:, 0]), order[:, 1 : keep + 1], _down(near[:, 1 : keep + 1]),
        _down(rest), np.full(len(points), keep + 1, np.int32), found.size,
    )


def moved(bounds: Bounds, movement: np.ndarray) -> Bounds:
    """Bounds after each entry has moved by at most ``movement``."""
    most = movement.max(initial=0.0)
    return replace(
        bounds,
        upper=_up(bounds.upper + movement[bounds.assigned]),
        lower=_down(bounds.lower - movement[bounds.near]),
        outer=_down(bounds.outer - most),
    )


def fewer(bounds: Bounds, keep: int) -> Bounds:
    """The same with ``keep`` ordered bounds; the others go into the outer one."""
    if keep >= bounds.near.shape[1]:
        return bounds
    outer = np.minimum(bounds.outer, bounds.lower[:, keep:].min(1))
    return replace(bounds, near=bounds.near[:, :keep], lower=bounds.lower[:, :keep], outer=outer)


def reassigned(points: np.ndarray, entries: np.ndarray, bounds: Bounds) -> Bounds:
    """The nearest entries, where ``bounds`` hold for the entries as they are now."""
    rows, keep = bounds.near.shape
    # What is below entry i of ``beyond`` is nearer than all near entries from i on.
    beyond = np.minimum.accumulate(np.column_stack([bounds.lower, bounds.outer])[:, ::-1], 1)[:, ::-1]
    settles = bounds.upper[:, None] < beyond
    depth = np.where(settles.any(1), settles.argmax(1), keep + 1).astype(np.int32)
    result = replace(
        bounds, assigned=bounds.assigned.copy(), upper=bounds.upper.copy(), near=bounds.near.copy(),
        lower=bounds.lower.copy(), outer=bounds.outer.copy(), depth=depth, compared=0,
    )
    for level in range(1, keep + 1):
        at = np.flatnonzero(depth == level)
        if not len(at):
            continue
        choice = np.column_stack([bounds.assigned[at], bounds.near[at, :level]])
        difference = points[at][:, None, :] - entries[choice]
        found = np.einsum("nkd,nkd->nk", difference, difference)
        order = np.lexsort((choice, found))
        choice, found = np.take_along_axis(choice, order, 1), np.take_along_axis(found, order, 1)
        near = np.sqrt(found.astype(np.float64))
        result.assigned[at], result.upper[at] = choice[:, 0], _up(near[:, 0])
        result.near[at, :level], result.lower[at, :level] = choice[:, 1:], _down(near[:, 1:])
        result.compared += found.size
    at = np.flatnonzero(depth == keep + 1)
    if len(at):
        every = compared_with_all(points[at], entries, keep)
        for name in ("assigned", "upper", "near", "lower", "outer"):
            getattr(result, name)[at] = getattr(every, name)
        result.compared += every.compared
    return result


@dataclass(frozen=True)
class Round:
    """What a pass over the rows needs: the codebooks, how far they moved, bounds to keep."""

    codebooks: np.ndarray  # parts x entries x components
    movement: np.ndarray | None  # parts x entries
    stored: tuple[int, ...]  # bounds in the table
    keep: tuple[int, ...]  # bounds to go on with


def _layout(parts: int, keep: tuple[int, ...]) -> np.dtype:
    """The bounds of one row, with ``keep`` ordered ones for each part."""
    return np.dtype([
        ("upper", "<f8", (parts,)), ("outer", "<f8", (parts,)), ("lower", "<f8", (sum(keep),)),
        ("near", "<i2", (sum(keep),)), ("depth", "<i2", (parts,)),
    ])


def _unpacked(column: pa.BinaryArray, kind: np.dtype | str, *shape: int) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    found = np.frombuffer(b"".join(column.to_pylist()), kind)
    return found.reshape(len(column), *shape) if shape else found


def _packed(rows: np.ndarray) -> pa.BinaryArray:
    rows = np.ascontiguousarray(rows)
    width = rows.nbytes // max(1, len(rows))
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    if offsets[-1] >= 1 << 31:
        raise ValueError("a slice of rows does not fit one batch")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(rows.tobytes())]
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), buffers)


def _pass(batch: pa.RecordBatch, now: Round) -> pa.RecordBatch:
    """One round over some rows.  The first one gets components as lists, the others packed."""
    parts, entries, width = now.codebooks.shape
    rows, cells = len(batch), batch.column("cells")
    if now.movement is None:
        points = cells.flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(rows, parts, width)
    else:
        points = _unpacked(cells, "<i8", parts, width)
        known = _unpacked(batch.column("bounds"), _layout(parts, now.stored))
        assigned = _unpacked(batch.column("assigned"), "u1", parts).astype(np.int64)
    error, codes = np.zeros(rows, np.int64), np.zeros((rows, parts), "u1")
    after = np.zeros(rows, _layout(parts, now.keep))
    read = kept = 0
    for p in range(parts):
        own, book = points[:, p], now.codebooks[p]
        if now.movement is None:
            bounds = compared_with_all(own, book, now.keep[p])
        else:
            stored = slice(read, read + now.stored[p])
            bounds = Bounds(
                assigned[:, p], known["upper"][:, p], known["near"][:, stored].astype(np.int64),
                known["lower"][:, stored], known["outer"][:, p],
            )
            read = stored.stop
            bounds = reassigned(own, book, fewer(moved(bounds, now.movement[p]), now.keep[p]))
        gap = own - book[bounds.assigned]
        error += np.einsum("nd,nd->n", gap, gap)
        codes[:, p] = bounds.assigned
        ordered = slice(kept, kept + now.keep[p])
        kept = ordered.stop
        after["near"][:, ordered], after["lower"][:, ordered] = bounds.near, bounds.lower
        for name in ("upper", "outer", "depth"):
            after[name][:, p] = getattr(bounds, name)
    return pa.RecordBatch.from_pydict({
        "vec_id": batch.column("vec_id"), "label": batch.column("label"), "cells": _packed(points),
        "bounds": _packed(after), "assigned": _packed(codes), "error": pa.array(error),
    })


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


def _sums(batches: Iterator[pa.RecordBatch], now: Round) -> Iterator[pa.RecordBatch]:
    """Rows by entry, sums of their components, and the deepest bound used, of one task."""
    parts, entries, width = now.codebooks.shape
    counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
    depth = np.zeros(parts, np.int64)
    for batch in _sliced(batches):
        cells = _unpacked(batch.column("cells"), "<i8", parts, width)
        at = _unpacked(batch.column("assigned"), "u1", parts) + np.arange(parts) * entries
        np.add.at(sums, at.ravel(), cells.reshape(-1, width))
        counts += np.bincount(at.ravel(), minlength=parts * entries)
        known = _unpacked(batch.column("bounds"), _layout(parts, now.keep))
        depth = np.maximum(depth, known["depth"].max(0))
    place = np.arange(parts * entries)
    yield pa.RecordBatch.from_pydict({
        "part": np.repeat(place // entries, width), "entry": np.repeat(place % entries, width),
        "place": np.tile(np.arange(width), parts * entries), "rows": np.repeat(counts, width),
        "total": sums.ravel(), "depth": np.repeat(np.repeat(depth, entries), width),
    })


def _movement(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    gap = after - before
    return _up(np.sqrt(np.einsum("pkd,pkd->pk", gap, gap).astype(np.float64)))


def _integer_rows(
    vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str
) -> DataFrame:
    vector = F.col(vector_col)
    usable = vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return vectors.filter(usable).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("cells"),
    )


def compress_vectors(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: one row per usable vector.

    Vectors that are null or hold null, NaN or infinity have no row.  Components become
    ``floor(scale * x)``.  Codebooks start as the parts of the ``entries`` smallest ids
    (null ids last, equal ids by their components); with fewer vectors they have fewer
    entries.  An entry that no part is nearest to stays what it was.  ``code`` has two hex
    digits a part, ``error`` sums the squared distances of all parts, and ``label_error``
    the errors of equal labels, nulls together.  Repeated rows are vectors of their own; a
    table without usable vectors gives no rows.  Other columns are not read.

    All vectors need the same length, a multiple of ``parts``, and integer components whose
    squared distances a 64-bit number holds; anything else is an error, never a wrong code.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    ship_package(spark)
    folder = scratch_folder(spark)
    rows = written(_integer_rows(vectors, scale, id_col, vector_col, label_col), f"{folder}/rows")
    shape = rows.agg(
        F.min(F.size("cells")).alias("least"), F.max(F.size("cells")).alias("most"),
        F.max(F.array_max(F.transform("cells", lambda x: F.abs(x)))).alias("largest"),
    ).first()
    length = shape["most"] or 0
    if shape["least"] != shape["most"] or length % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    if length and 4 * int(shape["largest"]) ** 2 * length >= 1 << 62:
        raise ValueError("components are too large for exact 64-bit distances")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "cells").limit(entries).collect()
    width, size = length // parts, len(first)
    if not size or not length:
        return _result(rows.select("*", F.lit(bytes(parts)).alias("assigned"), F.lit(0).cast("long").alias("error")), hashlib.sha256(b"").hexdigest())
    start = np.array([r["cells"] for r in first], np.int64).reshape(size, parts, width)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    least = min(max(1, size // 8), size - 1)
    keep = (min(max(1, size // 4), size - 1),) * parts
    now = Round(books, None, keep, keep)
    for turn in range(rounds + 1):
        # Two folders in turn: the state before is all that a lost executor needs.
        state = written(_assigned(rows, now), f"{folder}/state{turn % 2}")
        if turn == rounds:
            break
        books, depth = _averaged(state, now)
        wanted = tuple(int(min(b, max(least, d))) for b, d in zip(now.keep, depth))
        now = Round(books, _movement(now.codebooks, books), now.keep, wanted)
        rows = state
    numbers = ",".join(map(str, now.codebooks.ravel().tolist()))
    return _result(state, hashlib.sha256(numbers.encode()).hexdigest())


def _assigned(rows: DataFrame, now: Round) -> DataFrame:
    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            yield _pass(batch, now)

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(passed, f"vec_id long, label {label}, {STATE}")


def _averaged(state: DataFrame, now: Round) -> tuple[np.ndarray, np.ndarray]:
    """The codebooks after a round, and the deepest bound each part position needed."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sums(batches, now)

    kinds = "part long, entry long, place long, rows long, total long, depth long"
    sums = (
        state.select("cells", "assigned", "bounds")
        .mapInArrow(summed, kinds)
        .groupBy("part", "entry", "place")
        .agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.max("depth").alias("depth"))
    )
    books, depth = now.codebooks.copy(), np.zeros(len(now.codebooks), np.int64)
    for r in sums.collect():  # parts x entries x components rows
        if r["rows"]:
            books[r["part"], r["entry"], r["place"]] = r["total"] // r["rows"]
        depth[r["part"]] = max(depth[r["part"]], r["depth"])
    return books, depth


def _result(state: DataFrame, digest: str) -> DataFrame:
    """Codes and errors; the totals by label are written, so that a hot label can be split."""
    code = F.lower(F.hex("assigned")).alias("code")  # a byte a part
    totals = state.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    totals = written(totals, f"{scratch_folder(state.sparkSession)}/labels")
    return state.join(totals, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", code, "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
