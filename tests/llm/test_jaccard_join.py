"""The Jaccard join against comparing all sets."""

import re
from itertools import combinations

import numpy as np
import pytest
from corpus_tables import awkward, empty
from pyspark.sql import functions as F

from martflow.llm.jaccard_join import PartEnum, Shingles, Similarity, bitmap, similar_documents


def plain_set(text, words=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    size = min(words, len(found))
    return {tuple(found[k : k + size]) for k in range(len(found) - size + 1)} if size else set()


def plain_components(rows, percent=90):
    """(id, size, smallest id reached) of each row; rows are (id, text)."""
    sets = [plain_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    lowest = {}
    for k, (key, _) in enumerate(rows):
        known = [x for x in (key, lowest.get(find(k))) if x is not None]
        lowest[find(k)] = min(known, default=None)
    return sorted(((key, len(s), lowest[find(k)]) for k, ((key, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(docs, **options):
    return sorted(map(tuple, similar_documents(docs, **options).collect()), key=repr)


def near_copies(seed, groups=12, copies=9):
    """Texts with a few words changed, added or moved, about as much as the bound allows."""
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{x}" for x in random.integers(0, 3000, random.choice([2, 3, 9, 14, 30, 80, 200, 900]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(int(random.integers(0, 2 + len(base) // 45))):
                at = int(random.integers(0, len(words)))
                words[at : at + int(random.integers(0, 3))] = ["New"] * int(random.integers(0, 3))
            rows.append(" ".join(words))
    return [(int(k), text) for k, text in zip(random.permutation(len(rows)) - 20, rows)]


@pytest.mark.parametrize("seed", range(3))
def test_near_copies(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == plain_components(rows)


def test_other_similarities(spark):
    rows = near_copies(7, groups=5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, percent=80) == plain_components(rows, 80)


def test_awkward_rows(spark):
    docs = awkward(spark)
    more = [
        (30, " ".join(f"a{k}" for k in range(50)), None), (30, "another text of one id", None),
        (None, " ".join(f"A{k}" for k in range(50)), None), (None, "ANOTHER text\tof one id", "x"),
        (31, "only two", "x"), (32, "Only\ntwo", "x"), (33, "only", "x"), (34, " " * 3_000_000, "x"),
        (35, "one " + "\n" * 3_000_000 + "two", "x"), (36, "y" * 2_000_000 + " end of it", "x"),
    ]
    docs = docs.unionByName(
        spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True
    ).withColumns({n: F.lit(1) for n in ("row", "set_key", "size", "node", "lowest", "component", "signatures")})
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == plain_components(rows)
    assert found(empty(spark)) == []


def test_a_hot_group_of_copies_and_near_copies(spark):
    """A third are copies, a third near copies of one text; no pair is made for each two of them."""
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(900):
        words = base if k % 3 == 0 else [*base[: k % 57], f"x{k}", *base[k % 57 + 1 :]] if k % 3 == 1 else [f"y{k}-{j}" for j in range(9)]
        rows.append((k, " ".join(words)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)) == plain_components(rows)


@pytest.mark.parametrize("percent", [75, 90, 95])
def test_similar_sets_share_a_signature_and_close_bitmaps(percent):
    random = np.random.default_rng(percent)
    similarity = Similarity(percent)
    scheme = PartEnum(similarity)
    for size in [1, 2, 5, 9, 10, 11, 18, 19, 20, 21, 40, 57, 100, 333, 1000, 4000]:
        for _ in range(12):
            base = random.integers(0, 2**64, size * 2, dtype=np.uint64)
            added = int(random.integers(0, size // 8 + 1))
            removed = int(random.integers(0, size // 8 + 1))
            a, b = np.unique(base[:size]), np.unique(base[removed : size + added])
            both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if 100 * both >= percent * either and not np.array_equal(a, b):
                assert set(scheme.signatures(a).tolist()) & set(scheme.signatures(b).tolist())
                differing = int(np.bitwise_count((bitmap(a) ^ bitmap(b)).view(np.uint64)).sum())
                assert differing <= len(a) + len(b) - 2 * both <= similarity.differing(len(a) + len(b))


def test_signatures_stay_in_proportion():
    """A small set takes up to one signature for each of its elements, a large one far fewer."""
    scheme = PartEnum(Similarity(90))
    random = np.random.default_rng(1)
    for size, share in [(10, 1), (50, 1), (500, 0.45), (5000, 0.45), (50_000, 0.45)]:
        assert len(scheme.signatures(random.integers(0, 2**64, size, dtype=np.uint64))) <= share * size


def test_words_across_chunks():
    text = (b"ab  cde\tf " * 300_000).strip()
    whole = Shingles(3).of(text)
    assert len(whole) == len(plain_set(text.decode()))
    assert np.array_equal(whole, Shingles(3).of(b" ".join(text.split())))
