"""Exact, near and line duplicates against plain versions."""

import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from corpus_tables import SMALL, awkward, empty, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.llm.components import connected_components
from martflow.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from martflow.llm.line_dedup import drop_repeated_runs, repeated_runs
from martflow.llm.simhash import close_codes, drop_near_duplicates, fingerprint, near_duplicates

# -- exact ---------------------------------------------------------------------


def test_exact_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    found = exact_duplicates(docs).collect()
    assert len(found) == docs.count()
    groups = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r["doc_id"])
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_digest[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert (r["group_size"], r["keep_id"]) == (len(ids), min(known, default=None))
    assert sum(r["kept"] for r in found) == len(groups)


def test_a_group_over_many_sorted_partitions_is_one(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, "the\t one text").otherwise(F.col("id").cast("string")).alias("text"),
    )
    found = exact_duplicates(docs)
    large = found.filter("group_size > 1").agg(
        F.count("*"), F.min("keep_id"), F.max("keep_id"), F.min("group_size"), F.count_if("kept")
    ).first()
    assert tuple(large) == (2666, 1, 1, 2666, 1)
    assert found.filter("group_size = 1 AND kept").count() == 1334


@pytest.mark.parametrize("held", [1, 7, 200])
def test_runs_longer_than_a_task_holds(spark, held):
    rows = [(k if k % 9 else None, ["a", "b  c", "b c", None][k % 4] if k % 5 else f"own {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    short = sorted(map(tuple, exact_duplicates(docs).collect()), key=repr)
    assert sorted(map(tuple, exact_duplicates(docs, held=held).collect()), key=repr) == short
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"\s+", " ", text or "")].append(key)
    sizes = sorted(len(g) for g in groups.values() for _ in g)
    assert sorted(r[2] for r in short) == sizes and sum(r[3] for r in short) == len(groups)


def test_dropping_exact_copies_keeps_columns(spark):
    docs = awkward(spark)
    assert drop_exact_duplicates(docs).columns == docs.columns
    assert exact_duplicates(empty(spark)).count() == 0


# -- near ----------------------------------------------------------------------


def plain_fingerprint(text: str) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(
        1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes)
    )


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAé \n\tbZ ", max_size=60))
def test_fingerprint_of_any_text(text):
    assert fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)


def plain_components(codes: dict) -> dict:
    root = {k: k for k in codes}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(codes), 2):
        if (codes[a] ^ codes[b]).bit_count() <= 4:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: find(k) for k in codes}


def test_near_duplicates_of_all_documents(spark):
    texts = dict(rows(SMALL, "SELECT doc_id, text FROM documents"))
    codes = {k: plain_fingerprint(t) for k, t in texts.items()}
    wanted = plain_components(codes)
    found = near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {k: f"{c:016x}" for k, c in codes.items()}


@pytest.mark.parametrize("distance", [1, 4, 7])
def test_pigeonring_loses_no_pair(spark, distance):
    random = np.random.default_rng(distance)
    centres = random.integers(0, 2**63, 30, dtype=np.int64)
    codes = set()
    for centre in centres.tolist():
        for flips in range(0, distance + 3):
            places = random.choice(64, flips, replace=False).tolist()
            code = centre
            for p in places:
                code ^= -(1 << 63) if p == 63 else 1 << p
            codes.add(code)
    wanted = {
        (a, b) for a, b in combinations(sorted(codes), 2)
        if ((a ^ b) % 2**64).bit_count() <= distance
    }
    frame = spark.createDataFrame([(c,) for c in codes], "code long")
    pairs = [tuple(r) for r in close_codes(frame, distance).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == wanted


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100, 140)]
    star = [(7, k) for k in range(200, 260)] + [(3, 259)]
    found = connected_components(spark.createDataFrame(chain + star, "a long, b long"))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert roots == {k: 100 for k in range(100, 141)} | {k: 3 for k in [3, 7, *range(200, 260)]}


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    found = near_duplicates(docs)
    assert found.count() == docs.count()
    blank = found.filter("fingerprint = '0000000000000000'").select("component_id").distinct()
    assert [r[0] for r in blank.collect()] == [1]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id = 6").count() == 0 and kept.filter("doc_id = 7").count() == 3
    assert near_duplicates(empty(spark)).count() == 0
    assert drop_near_duplicates(empty(spark)).count() == 0


# -- lines ---------------------------------------------------------------------


def plain_line_dedup(texts: dict, least: int = 50) -> dict:
    """Every run of lines, of any length, compared with every earlier one."""
    worded = {}
    for key in sorted(texts):
        lines = (texts[key] or "").split("\n")
        worded[key] = [(n, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for n, x in enumerate(lines)]
        worded[key] = [w for w in worded[key] if w[2]]
    seen, gone = set(), defaultdict(set)
    for key, lines in worded.items():
        for a in range(len(lines)):
            total, content = 0, hashlib.md5()
            for n, line, words in lines[a:]:
                total += words
                content.update(line.encode() + b"\n")
                if total >= least:
                    digest = content.digest()
                    if digest in seen:
                        gone[key].update(m for m, _, _ in lines[a:] if m <= n)
                    seen.add(digest)
        for (before, _, _), (after, _, _) in zip(lines, lines[1:]):
            if {before, after} <= gone[key]:
                gone[key].update(range(before, after))
    return {
        key: "\n".join(x for n, x in enumerate((text or "").split("\n")) if n not in gone[key])
        for key, text in texts.items()
    }


def test_line_dedup_of_all_documents(spark):
    texts = dict(rows(SMALL, "SELECT doc_id, text FROM documents"))
    found = drop_repeated_runs(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert {r["doc_id"]: r["text"] for r in found} == plain_line_dedup(texts)


def test_line_dedup_of_short_lines_and_overlaps(spark):
    random = np.random.default_rng(5)
    texts = {
        key: "\n".join(random.choice(["a", "b b", "", "c c c", "d"], 40).tolist()) for key in range(12)
    }
    texts |= {100: "x y\n" * 9, 101: "one two three\nfour five\n\nsix", 102: "a\none two three\nfour five\n \nsix"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for least in (2, 5, 9):
        found = drop_repeated_runs(docs, min_words=least).collect()
        assert {r["doc_id"]: r["text"] for r in found} == plain_line_dedup(texts, least)


def test_line_dedup_of_awkward_rows(spark):
    docs = awkward(spark)
    clean = drop_repeated_runs(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in clean.filter("doc_id IN (1, 5, 6, 8, 9)").collect()}
    assert texts[1] is None and texts[5].startswith("line 0") and texts[6] == ""
    # The row without an id holds the passage too, and comes first.
    assert texts[8] == "first line\nlast line" and texts[9] == "\nother end"
    assert clean.filter("doc_id = 7").select("text").distinct().count() == 2
    assert repeated_runs(empty(spark)).count() == 0
    assert drop_repeated_runs(empty(spark)).columns == docs.columns
