"""The pipeline's stages against plain versions, each on its own input."""

import math
from collections import Counter

import pytest
from corpus_tables import SMALL, awkward, empty, rows
from test_decontamination import plain_leaks
from test_dedup import plain_components, plain_fingerprint, plain_line_dedup
from test_sharding_packing import check_packing, tokenizer  # noqa: F401

import corpus_pipeline
from martflow.llm import language_id
from martflow.llm.common import in_held_out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage read and wrote."""
    folder = tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(folder / name))
        found[name] = (docs, spark.read.parquet(str(folder / name)))
        docs = found[name][1]
    return found


def texts(frame) -> dict:
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns


def plain_margin(text: str, model) -> float:
    """How far a text's cosine is above the reach of its nearest centroid, n-gram by n-gram."""
    folded = []
    for byte in text.encode():
        letter = 65 <= byte <= 90 or 97 <= byte <= 122 or byte >= 128
        sign = (byte + 32 if byte <= 90 else byte) if letter else 48 if 48 <= byte <= 57 else 32
        if sign != 32 or not folded or folded[-1] != 32:
            folded.append(sign)
    codes = [a + (b << 8) + (1 << 24) for a, b in zip(folded, folded[1:])]
    codes += [a + (b << 8) + (c << 16) for a, b, c in zip(folded, folded[1:], folded[2:])]
    counts = Counter((code * 2654435761 % 2**32) >> 20 for code in codes)
    weights = {slot: math.log1p(n) * float(model.idf[slot]) for slot, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values())) or 1
    cosines = [sum(w * float(c[slot]) for slot, w in weights.items()) / norm for c in model.centroids]
    best = max(range(len(cosines)), key=lambda k: cosines[k])
    kind = sum(len(weights) >= k for k in language_id.KINDS.tolist())
    return min(max(cosines[best], 0), 1) - float(model.reach[best][kind])


def test_language_stage(spark, stages):
    before, after = stages["language_id"]
    model = language_id.train(before.filter(~in_held_out(before["doc_id"])))
    given, kept = texts(before), texts(after)
    for key, text in given.items():
        margin = plain_margin(text, model)
        wanted = any(c.isalpha() for c in text) and margin >= 0
        assert (key in kept) == wanted or abs(margin) < 1e-5  # the operator's numbers have 32 bits
    assert kept == {k: given[k] for k in kept} and len(kept) > 0.98 * len(given)


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    assert texts(after) == plain_line_dedup(texts(before))
    assert after.filter("n_chars <> length(text)").count() == 0


def test_near_duplicate_stage(stages):
    before, after = stages["simhash_near_dedup"]
    given = texts(before)
    roots = plain_components({k: plain_fingerprint(t) for k, t in given.items()})
    assert texts(after) == {k: given[k] for k in set(roots.values())}


def test_decontamination_stage(stages):
    before, after = stages["decontamination"]
    given = texts(before)
    items = dict(rows(SMALL, "SELECT item_id, text FROM benchmark"))
    gone = set(given) - set(texts(after))
    assert gone <= {k for k, _ in plain_leaks(given, items)}
    assert gone >= {k for k, _ in plain_leaks(given, items, 0.8)}


def test_packing_stage(stages, tokenizer):  # noqa: F811
    before, after = stages["packing"]
    check_packing(after.collect(), texts(before), tokenizer)


def test_run_gives_what_the_stages_give(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, SMALL).select(*columns).collect()
    wanted = stages["packing"][1].select(*columns).collect()
    total = lambda rs: sum(r["length"] for r in rs)
    assert total(found) == total(wanted) and {r["doc_id"] for r in found} == {r["doc_id"] for r in wanted}


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_take_awkward_rows(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SMALL)
        assert found.columns == docs.columns and found.count() <= docs.count()
    assert corpus_pipeline.packing_stage(spark, docs, SMALL).filter("start = 0").count() == docs.count()
