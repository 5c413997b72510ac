"""Rendezvous shards against plain hashing, packed windows against the tokenizer."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from corpus_tables import MEDIUM, SMALL, awkward, empty, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martflow.llm.packing import pack_documents
from martflow.llm.queries import op5_sharding, op9_packing
from martflow.llm.sharding import assign_shards, rendezvous_shard
from martflow.llm.tokens import chunks, token_ids

# -- sharding ------------------------------------------------------------------


def plain_shard(key: str, weights: list[float]) -> int:
    def score(shard: int) -> float:
        first = xxhash.xxh64(key.encode(), seed=42).intdigest()
        code = xxhash.xxh64(struct.pack("<i", shard), seed=first).intdigest()
        return weights[shard] / -math.log(((code >> 11) + 0.5) / 2**53)

    return max(range(len(weights)), key=score)


def test_shards_of_all_documents(spark):
    found = op5_sharding(spark, MEDIUM).collect()
    for r in found:
        assert r["shard"] == plain_shard(str(r["doc_id"]), [1.0] * 8)
        assert r["grown_shard"] in (r["shard"], 8)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = dict(rows(MEDIUM, "SELECT doc_id, text FROM documents"))
    for r in found:
        data = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")


def test_weights_set_the_shares(spark):
    shard = rendezvous_shard(F.col("id"), [1.0, 3.0, 4.0])
    counts = dict(spark.range(80_000).groupBy(shard.alias("s")).count().collect())
    assert [round(counts[s] / 10_000) for s in range(3)] == [1, 3, 4]


def test_slots_with_one_hot_key_over_many_partitions(spark):
    hot = spark.range(5000).select(F.lit(9).cast("long").alias("k"), F.lit(1).alias("slot"))
    found = assign_shards(hot.repartition(7), "k", [1.0, 1.0])
    assert found.columns == ["k", "slot", "shard", "_slot"]
    assert [r[0] for r in found.select("_slot").orderBy("_slot").collect()] == list(range(5000))


def test_shards_of_awkward_rows(spark):
    docs = awkward(spark)
    found = assign_shards(docs, "doc_id", [1.0, 2.0], [1.0, 2.0, 1.0])
    assert found.count() == docs.count() and found.columns[: len(docs.columns)] == docs.columns
    assert found.groupBy("doc_id").agg(F.countDistinct("_shard").alias("n")).filter("n > 1").count() == 0
    assert assign_shards(empty(spark), "doc_id", [1.0]).count() == 0
    with pytest.raises(ValueError):
        rendezvous_shard(F.col("doc_id"), [1.0, 0.0])


# -- packing -------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check_packing(pieces, texts: dict, tokenizer) -> None:
    """Each document's ids, once each and in order, in windows without holes."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_window[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for key, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(by_doc[key], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            part = ids[at : at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += p["length"]
        assert at == len(ids)
    for window in by_window.values():
        at = 0
        for p in sorted(window, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 1024 and (at == window[0]["window"] or window[0]["window"] == 1024)


def test_packing_of_all_documents(spark, tokenizer):
    pieces = op9_packing(spark, MEDIUM).collect()
    check_packing(pieces, dict(rows(MEDIUM, "SELECT doc_id, text FROM documents")), tokenizer)
    windows = {p["sequence_id"]: p["window"] for p in pieces}
    assert sum(p["length"] for p in pieces) / sum(windows.values()) > 0.998
    steps = Counter()
    for p in pieces:
        steps[p["step"]] += p["length"] ** 2
    assert len(steps) > 10 and max(steps.values()) / min(steps.values()) < 1.15


def test_each_tier_has_windows_of_its_own(spark):
    pieces = op9_packing(spark, MEDIUM).collect()
    by_window, tiers, steps = defaultdict(int), {}, defaultdict(Counter)
    for p in pieces:
        by_window[p["sequence_id"]] += p["length"]
        tiers[p["sequence_id"]] = p["window"], p["step"]
    found = Counter(tier for tier, _ in tiers.values())
    assert set(found) == {1024, 512, 256, 128} and min(found.values()) >= 10
    partial = [k for k, (tier, _) in tiers.items() if by_window[k] < tier]
    assert len(partial) <= len({k >> 33 for k in tiers})  # the last one of a task
    for tier, step in tiers.values():
        steps[step][tier] += 1
    for tier in found:  # steps hold near equal numbers of windows of each tier
        assert max(s[tier] for s in steps.values()) - min(s[tier] for s in steps.values()) <= 1 + len({k >> 33 for k in tiers})


def test_packing_of_awkward_rows(spark, tokenizer):
    docs = awkward(spark)
    apart = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in apart.select("doc_id", "text").collect()}
    check_packing(pack_documents(apart).collect(), texts, tokenizer)
    repeated = pack_documents(docs.filter("doc_id = 7 OR doc_id IS NULL"))
    assert repeated.filter("start = 0").count() == 6
    assert pack_documents(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        pack_documents(docs, tiers=(1000, 500))


def test_token_ids_are_those_of_the_tokenizer(tokenizer):
    for (text,) in rows(SMALL, "SELECT text FROM documents"):
        assert token_ids(text) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_token_ids_of_any_text(text):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not OWN else OWN[0]
    OWN.append(own)
    own.encode_special_tokens = True
    assert token_ids(text) == own.encode(text, add_special_tokens=False).ids


OWN: list = []


@pytest.mark.parametrize("text", [
    " " * 2_000_000, "\n" * 2_000_000 + "word", "a" + " \t\u3000\xa0" * 300_000 + " b  c", "!-" * 1_000_000,
    "\u6f22\u5b57" * 500_000, "x" * 1_000_000, "1" * 1_000_000, ("\r\n" * 20_000 + "it's \x1c ") * 30,
])
def test_token_ids_of_long_stretches(tokenizer, text):
    assert token_ids(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_very_long_texts_are_cut_where_tokens_end():
    text = "Some plain words, 12 numbers and  gaps\n of text. " * 400
    parts = list(chunks(text, size=1000))
    assert len(parts) > 10 and "".join(parts) == text
    assert [i for p in parts for i in token_ids(p)] == token_ids(text)
