"""The filter audit against applying every order of filters by hand."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from corpus_tables import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.llm.filter_audit import audit_filters, audit_patterns, few_words, holds_any

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failures(rows):
    """Letters each row fails, in row order, from the definitions."""
    smallest = {}
    for key, text, *_ in rows:
        if key is not None:
            smallest[text or ""] = min(key, smallest.get(text or "", key))
    found = []
    for key, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        low = smallest.get(text)
        found.append({
            letter for letter, failed in (
                ("A", len(words) < 50),
                ("B", 100 * len(set(words)) < 65 * len(words)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
                ("D", re.search(r"[#$%&*|]", text)),
                ("E", low is not None and (key is None or key > low)),
            ) if failed
        })
    return found


def plain_audit(rows, failed, good=(), toxic=(), letters="ABCDE"):
    """(part, order, step) -> counts and the filter's removals over all orders."""
    parts = defaultdict(list)
    for (key, _, part), f in zip(rows, failed):
        parts[part or ""].append((key, f))
    found, removed_by = {}, Counter()
    for part, docs in parts.items():
        for order in map("".join, permutations(letters)):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                removed_by[part, letter] += len(gone)
                failing = sum(letter in f for _, f in docs)
                found[part, order, step] = (
                    len(left), len(gone), failing - len(gone), sum(f == {letter} for _, f in docs),
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                )
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def audited(frame):
    return {
        (r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in [*COUNTS, "shapley"])
        for r in frame.collect()
    }


def test_awkward_rows(spark):
    docs = awkward(spark)
    more = [
        (20, "Word " * 60 + "#", None, None, None), (21, "Word " * 60 + "#", None, "", 1),
        (22, " ".join(f"w{k}" for k in range(80)), None, "b", 1), (23, "ABC " * 3, None, "b", None),
        (24, "\n" * 300_000 + "x|y", None, "c", None), (22, " ".join(f"w{k}" for k in range(80)), None, "c", 1),
    ]
    docs = docs.unionByName(
        spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"),
        allowMissingColumns=True,
    ).withColumns({name: F.lit(1) for name in ("digest", "failed", "docs", "lowest", "filter", "potential")})
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (7, 1, 1), (21, 1, None), (22, None, 1), (None, 1, 1), (5, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    ).withColumns({name: F.lit(1) for name in ("labelled", "source", "good")})
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.select("doc_id", "text", "source").collect()]
    wanted = plain_audit(rows, failures(rows), good={1, 7, 21, 5}, toxic={1, 7, 22})
    assert audited(audit_filters(docs, labels)) == wanted


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(empty(spark), labels).count() == 0
    found = audited(audit_filters(awkward(spark), labels))
    assert len(found) == 600 * 3 and all(v[4:6] == (0, 0) for v in found.values())


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a", "x"), (3, "a#", None)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int")
    filters = {"S": few_words(2), "H": holds_any("#")}
    found = audited(audit_filters(docs, labels, filters, copies="K"))
    wanted = plain_audit(
        [(1, "", "x"), (2, "", "x"), (3, "", None)], [set(), {"S"}, {"S", "H"}], {3}, {3}, letters="SHK"
    )
    assert found == wanted
    with pytest.raises(ValueError):
        audit_filters(docs, labels, {c: few_words(1) for c in "ABCDEF"})


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "p"]), st.sets(st.sampled_from("ABCDE"))), min_size=1, max_size=40))
def test_any_patterns(spark, docs):
    counted = Counter((part, sum(1 << "ABCDE".index(c) for c in f)) for part, f in docs)
    patterns = spark.createDataFrame(
        [(part, failed, n, 0, 0) for (part, failed), n in counted.items()],
        "part string, failed int, docs long, good long, toxic long",
    )
    rows = [(k, "", part) for k, (part, _) in enumerate(docs)]
    assert audited(audit_patterns(patterns, "ABCDE")) == plain_audit(rows, [f for _, f in docs])
