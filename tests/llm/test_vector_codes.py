"""Vector codes against plain Lloyd rounds in integers."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from corpus_tables import SMALL
from pyspark.sql import functions as F

from martflow.llm import vector_codes
from martflow.llm.vector_codes import Bounds, compared_with_all, compress_vectors, fewer, moved, reassigned, squared

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, code, error, label_error, digest) by comparing every entry every time."""
    kept = [
        (key, [math.floor(scale * float(x)) for x in vector], label)
        for key, vector, label in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(own, book):
        return min((sum((a - b) ** 2 for a, b in zip(own, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for k, members in groups.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    return [
        (key, "".join(f"{k:02x}" for _, k in f), e, by_label[label], digest)
        for (key, _, label), f, e in zip(kept, found, errors)
    ]


def compressed(frame, **options):
    return sorted(map(tuple, compress_vectors(frame, **options).collect()), key=repr)


def test_whole_table(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    assert compressed(frame) == sorted(plain_codes(rows), key=repr)


def awkward_vectors():
    random = np.random.default_rng(3)
    rows = [
        (k if k % 7 else None, [float(x) for x in random.integers(-3, 4, 16) / 4096], [None, 1, 2][k % 3])
        for k in range(60)
    ]
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 1), (5, rows[9][1], 2)]  # rows and ids that repeat
    rows += [(70 + k, [0.0] * 16, None) for k in range(9)]
    return rows, [
        (100, None, 1), (101, [None] + [0.0] * 15, 1), (102, [float("nan")] + [0.0] * 15, 2),
        (103, [float("inf")] * 16, None), (1, None, None),
    ]


def test_awkward_vectors(spark):
    rows, dropped = awkward_vectors()
    frame = spark.createDataFrame(rows + dropped, SCHEMA).repartition(5)
    for name in ("cells", "code", "error", "assigned", "of_label", "depth", "label_error"):
        frame = frame.withColumn(name, F.lit(1))
    for entries in (16, 3, 1):
        options = dict(parts=4, entries=entries, rounds=4)
        assert compressed(frame, **options) == sorted(plain_codes(rows, **options), key=repr)


def test_few_and_no_vectors(spark):
    rows, dropped = awkward_vectors()
    few = spark.createDataFrame(rows[:4], SCHEMA)
    assert compressed(few) == sorted(plain_codes(rows[:4]), key=repr)
    assert compressed(spark.createDataFrame(dropped, SCHEMA)) == []
    assert compressed(few.limit(0)) == []


def test_a_hot_vector_and_label(spark):
    rows = [(k, [0.25] * 16 if k % 3 else [k / 512.0 + j for j in range(16)], 1) for k in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert compressed(frame) == sorted(plain_codes(rows), key=repr)


@pytest.mark.parametrize("vector", [[0.0] * 15, [1e7] * 16])
def test_what_cannot_be_exact_is_an_error(spark, vector):
    with pytest.raises(ValueError):
        compress_vectors(spark.createDataFrame([(1, [0.0] * 16, 1), (2, vector, 1)], SCHEMA))


@pytest.mark.parametrize("seed", range(5))
def test_bounds_hold_and_save_distances(seed):
    """Entries that drift, for many rounds: nearest entries are exact, and bounds stay bounds."""
    random = np.random.default_rng(seed)
    points = random.integers(-40, 40, (400, 4))
    entries = random.integers(-40, 40, (16, 4))
    bounds: Bounds = compared_with_all(points, entries, 4)
    compared = 0
    for turn in range(12):
        before, entries = entries, entries + random.integers(-1, 2, entries.shape) * (turn % 3 > 0)
        movement = np.sqrt(((entries - before) ** 2).sum(1)) * (1 + vector_codes.WIDER)
        bounds = reassigned(points, entries, fewer(moved(bounds, movement), 4 - turn // 4))
        compared += bounds.compared
        exact = squared(points, entries)
        assert (bounds.assigned == exact.argmin(1)).all()
        assert (bounds.upper >= np.sqrt(exact.min(1)) - 1e-9).all()
        near = np.take_along_axis(exact, bounds.near, 1)
        assert (bounds.lower <= np.sqrt(near) + 1e-9).all()
        rest = exact.astype(float)
        np.put_along_axis(rest, np.column_stack([bounds.assigned, bounds.near]), np.inf, 1)
        assert (bounds.outer <= np.sqrt(rest.min(1)) + 1e-9).all()
    assert compared < 0.7 * 12 * exact.size
