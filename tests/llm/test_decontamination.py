"""Leaks of benchmark items against a search of every text for every item."""

import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_tables import MEDIUM, awkward, empty, rows

from martflow.llm import decontamination as d


def words(text: str) -> list[bytes]:
    return d.words_of((text or "").lower().encode())


def plain_leaks(texts: dict, items: dict, least: float = d.ENOUGH) -> set:
    """Pairs with enough common words around any place where three words in a row agree."""
    starts: dict = {}
    split = {i: words(t) for i, t in items.items()}
    for i, own in split.items():
        for k in range(len(own) - 2):
            starts.setdefault(tuple(own[k : k + 3]), set()).add(i)
    found = set()
    for key, text in texts.items():
        own = words(text)
        for k in range(len(own) - 2):
            for i in starts.get(tuple(own[k : k + 3]), ()):
                n = len(split[i])
                if d.common_length(split[i], own[max(0, k - n) : k + n + 3]) >= least * n:
                    found.add((key, i))
    return found


@pytest.fixture(scope="module")
def items():
    return dict(rows(MEDIUM, "SELECT item_id, text FROM benchmark"))


@pytest.fixture(scope="module")
def texts():
    return dict(rows(MEDIUM, "SELECT doc_id, text FROM documents"))


def test_all_leaks_and_only_leaks(spark, items, texts):
    found = d.find_leaks(
        spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    )
    found = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    wanted = plain_leaks(texts, items)
    assert len(wanted) > 10
    assert len(found & wanted) >= 0.9 * len(wanted) and found <= wanted


def test_paraphrases_are_found(spark, items, texts):
    """One word in six replaced, dropped or doubled, and another one in between."""
    turn = random.Random(4)
    carriers = [t for k, t in texts.items() if len(words(t)) > 200][: len(items)]
    planted = []
    for k, (item, carrier) in enumerate(zip(items.values(), carriers)):
        own = item.split()
        for at in turn.sample(range(len(own)), len(own) // 6):
            own[at] = turn.choice(["", "other", f"{own[at]} more"])
        half = carrier.split()
        planted.append((k, " ".join(half[:90] + own + half[90:])))
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items.values())), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()}
    assert sum((k, k) in found for k in range(len(planted))) >= 0.9 * len(planted)


@pytest.mark.parametrize(("part", "least"), [(0.3, 1.0), (0.38, 0.9)])
def test_leaks_that_lack_the_rarest_words_of_an_item_are_found(spark, items, texts, part, least):
    turn = random.Random(11)
    often: dict = {}
    for text in texts.values():
        for w in set(words(text)):
            often[w] = often.get(w, 0) + 1
    carriers = [words(t) for k, t in sorted(texts.items()) if len(words(t)) > 200]
    planted, wanted, vocabulary = [], set(), sorted(often)
    for k, text in sorted(items.items()):
        own = words(text)
        changed, last = list(own), max(len(words(d.answer_of(text))), 1)
        for at in sorted(range(len(own)), key=lambda j: (often.get(own[j], 0), turn.random()))[: round(part * len(own))]:
            changed[at] = turn.choice(vocabulary)
        share = d.common_length(own, changed) / len(own)
        answer = sum(d.common_words(own, changed)[-last:]) / last
        if share >= d.CLEAR or (share >= d.ENOUGH and answer >= d.ANSWER):
            wanted.add((k, k))
        host = turn.choice(carriers)
        planted.append((k, b" ".join([*host[:90], *changed, *host[90:]]).decode()))
    docs = spark.createDataFrame(planted, "doc_id long, text string").unionByName(
        spark.read.parquet(f"{MEDIUM}/documents.parquet").selectExpr("-1 - doc_id AS doc_id", "text")
    )
    found = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, spark.read.parquet(f"{MEDIUM}/benchmark.parquet")).collect()}
    assert len(wanted) > 30
    assert len(found & wanted) >= least * len(wanted)


def planted_items(texts: dict, lengths: tuple, each: int) -> tuple[list, dict]:
    """(key, document) with an item in the midst of each, and the items, cut from other documents."""
    turn = random.Random(7)
    pool = [w for k in sorted(texts)[::2] for w in texts[k].split() if words(w)]
    carriers = [t.split() for k, t in sorted(texts.items())[1::2] if len(words(t)) > 200]
    docs, items = [], {}
    for key, n in enumerate(n for n in lengths for _ in range(each)):
        at, carrier = turn.randrange(len(pool) - n), carriers[key % len(carriers)]
        cut = turn.randrange(90, 130)
        items[key] = " ".join(pool[at : at + n])
        docs.append((key, " ".join([*carrier[:cut], items[key], *carrier[cut:]])))
    return docs, items


def test_items_of_all_lengths_are_found(spark, texts):
    lengths = (5, 8, 12, 16, 24, 32, 60, 65, 120, 200, 400, 1000)
    docs, items = planted_items(texts, lengths, 20)
    found = d.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(list(items.items()), "item_id long, text string"),
    )
    found = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    lost = [len(items[k].split()) for k in items if (k, k) not in found]
    assert not lost


def test_candidates_of_the_index_against_brute_force(spark, items, texts):
    """The windows that hold an item are among the candidates."""
    own = [d.Item(k, words(t), 1) for k, t in items.items()]
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("text")
    retriever = d._retriever(own, docs, docs.limit(50).selectExpr("text", "1D AS weight"))
    wanted = plain_leaks(texts, items, 0.8)
    keys = sorted({a for a, _ in wanted})
    hit = {(keys[t], own[k].key) for t, k, _, _ in retriever.candidates([words(texts[key]) for key in keys])}
    assert len(hit & wanted) >= 0.9 * len(wanted)


def test_svd_is_that_of_the_matrix(spark):
    vocabulary = [f"w{k}".encode() for k in range(40)]
    slots = {w: k for k, w in enumerate(vocabulary, 1)}
    pick = np.random.default_rng(2)
    groups = [pick.choice(40, 8, replace=False) for _ in range(4)]
    passages = [" ".join(f"w{k}" for k in pick.choice(groups[n % 4], 12)) for n in range(80)]
    idf = np.ones(41, np.float32)
    idf[0] = 0
    frame = spark.createDataFrame([(p, 1.0) for p in passages], "text string, weight double")
    basis = d.randomised_svd(frame, slots, idf, rank=4)
    matrix = np.zeros((80, 41))
    for n, p in enumerate(passages):
        for w in p.split():
            matrix[n, slots[w.encode()]] += 1
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    exact = np.linalg.svd(matrix, full_matrices=False)[2][:4]
    assert np.linalg.svd(exact @ basis, compute_uv=False).min() > 0.99


def test_common_subsequences():
    turn = random.Random(1)
    for _ in range(200):
        a = [bytes([turn.choice(b"abcd")]) for _ in range(turn.randint(1, 12))]
        b = [bytes([turn.choice(b"abcde")]) for _ in range(turn.randint(0, 15))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert d.common_length(a, b) == best[-1][-1] == sum(d.common_words(a, b))


def test_an_answer_that_is_missing_clears_a_document(spark):
    question = " ".join(f"word{k}" for k in range(30))
    bench = spark.createDataFrame([(1, question + " the final answer", "the final answer")], "item_id long, text string, answer string")
    near = " ".join(f"word{k}" if k % 5 else f"else{k}" for k in range(30))
    docs = spark.createDataFrame(
        [(1, near), (2, near + " the final answer"), (3, question)], "doc_id long, text string"
    )
    found = d.find_leaks(docs, bench, answer_col="answer").collect()
    assert {r["doc_id"] for r in found} == {2, 3}


def test_awkward_rows(spark):
    docs = awkward(spark)
    passage = "  ".join(f"SHARED{k}" for k in range(60))
    bench = spark.createDataFrame(
        [(1, passage), (1, passage), (2, None), (3, ""), (4, "?!"), (None, "two words")],
        "item_id long, text string",
    )
    found = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()}
    assert found == {(8, 1), (9, 1), (None, 1)}
    left = d.drop_leaks(docs, bench)
    assert left.columns == docs.columns
    assert left.filter("doc_id IN (8, 9) OR doc_id IS NULL").count() == 0
    assert left.count() == docs.filter("doc_id NOT IN (8, 9)").count()
    assert d.find_leaks(empty(spark), bench).count() == 0
    assert d.find_leaks(docs, bench.limit(0)).count() == 0
    assert d.drop_leaks(docs, bench.limit(0)).count() == docs.count()


def test_folding_of_letters():
    assert d.folded(pa.array(["ÉCOLE, Été!"])) == ["école, été!".encode()]
    assert d.words_of("école, été!".encode()) == ["école".encode(), "été".encode()]


def test_every_leak_of_the_fixture_is_found(spark, items, texts):
    found = d.find_leaks(
        spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    )
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == plain_leaks(texts, items)


def test_a_foreign_word_that_repeats_hides_no_leak(spark):
    question = " ".join(f"word{k}" for k in range(30))
    bench = spark.createDataFrame([(1, question + " the final answer", "the final answer")], "item_id long, text string, answer string")
    near = " ".join(f"word{k}" if k % 5 else "else" for k in range(30))
    docs = spark.createDataFrame(
        [(1, near), (2, near + " the final answer"), (3, question)], "doc_id long, text string"
    )
    found = d.find_leaks(docs, bench, answer_col="answer").collect()
    assert {r["doc_id"] for r in found} == {2, 3}


def test_every_document_shapes_the_space(spark, monkeypatch):
    docs = spark.range(1500).selectExpr("id AS doc_id", "concat('word', id, ' and some others') AS text")
    bench = spark.createDataFrame([(1, "word7 and some others")], "item_id long, text string")
    seen, fit = [], d.randomised_svd
    monkeypatch.setattr(d, "randomised_svd", lambda rows, *a, **o: seen.append(rows.count()) or fit(rows, *a, **o))
    assert (7, 1) in {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()}
    assert seen == [1501]


def test_words_are_counted_over_all_documents(spark, texts):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("text")
    wanted: dict = {}
    for text in texts.values():
        for w in set(words(text)):
            wanted[w] = wanted.get(w, 0) + 1
    assert {bytes(r["word"]): r["docs"] for r in d._counted_words(docs).collect()} == wanted


def test_words_split_as_arrays():
    given = [None, "", "  ", "?!", "ÉCOLE, Été!", " a\x00b\x1f  c ", "\x85x\xa0y", "İIß", "one two"]
    split, sizes = d.split_words(pa.array(["cut off", *given])[1:])
    plain = [d.words_of(text or b"") for text in d.folded(pa.array(given))]
    assert sizes.tolist() == [len(own) for own in plain]
    assert split.cast(pa.large_binary()).to_pylist() == [w for own in plain for w in own]
    slots = {b"c": 1, "été".encode(): 2}
    found = d.placed(pa.array(given), d.vocabulary_of(slots))
    assert [own.tolist() for own in found] == [[slots.get(w, 0) for w in own] for own in plain]
