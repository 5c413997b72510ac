"""Held-out accuracy of the trained models, and what awkward rows get."""

import dataclasses

import numpy as np
from corpus_tables import MEDIUM, awkward, empty, rows
from pyspark.sql import functions as F

from martflow.llm import language_id, quality
from martflow.llm.queries import op3_language_id, op8_quality


def test_languages_of_held_out_documents(spark):
    lang = dict(rows(MEDIUM, "SELECT doc_id, lang FROM documents"))
    found = op3_language_id(spark, MEDIUM).collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 100
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["rejected"] for r in found) <= 2


def test_predictions_follow_the_text_alone(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(300)
    model = language_id.train(docs)
    texts = [r["text"].encode() for r in docs.orderBy("doc_id").collect()]
    cosine = language_id.unit_vectors(texts, model.idf) @ model.centroids.T
    wanted = [model.languages[k] for k in cosine.argmax(1)]
    found = language_id.identify_languages(docs.drop("lang", "source"), model).orderBy("doc_id")
    assert [r["lang_pred"] for r in found.collect()] == wanted


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language_id.train(docs)
    assert len(model.languages) == 4 * language_id.CENTROIDS
    other = spark.createDataFrame([(1, "Это совсем другой язык"), (2, "完全不同的語言")], "doc_id long, text string")
    assert [r["rejected"] for r in language_id.identify_languages(other, model).collect()] == [True, True]


def test_languages_of_awkward_rows(spark):
    docs = awkward(spark)
    model = language_id.train(docs)
    found = language_id.identify_languages(docs, model)
    assert found.count() == docs.count()
    unknown = found.filter("lang_pred = 'und'").select("doc_id", "score", "rejected").collect()
    assert {tuple(r) for r in unknown} == {(k, 0.0, True) for k in (None, 1, 2, 3, 4, 11, 13)}
    assert language_id.drop_unidentified(docs, model).columns == docs.columns
    none = language_id.train(empty(spark))
    assert none is None and language_id.identify_languages(empty(spark), none).count() == 0
    assert language_id.identify_languages(docs, None).filter("lang_pred <> 'und'").count() == 0


def test_kmeans_finds_separate_groups():
    random = np.random.default_rng(1)
    centres = np.eye(6, 40)[:3]
    points = np.repeat(centres, 20, axis=0) + random.normal(0, 0.05, (60, 40))
    points = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)
    found = language_id.spherical_kmeans(points, 3)
    assert sorted((found @ centres.T).argmax(1).tolist()) == [0, 1, 2]


def test_quality_of_held_out_documents(spark):
    label = dict(rows(MEDIUM, "SELECT doc_id, quality FROM labels"))
    found = [r for r in op8_quality(spark, MEDIUM).collect()]
    held = [(r["score"], label[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in label]
    good = [s for s, y in held if y == 1]
    bad = [s for s, y in held if y == 0]
    assert len(good) > 20 and len(bad) > 3
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.3) == (y == 1) for s, y in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found)


def test_the_risk_is_held_at_zero():
    random = np.random.default_rng(3)
    good = random.normal(1.0, 1, (400, 5)).astype(np.float32)
    mixed = np.concatenate([random.normal(1.0, 1, (600, 5)), random.normal(-1.5, 1, (400, 5))])
    model = quality.fit_positive_unlabelled(good, mixed.astype(np.float32), prior=0.6)
    scores = model.scores(mixed)
    assert np.mean((scores > 0.5) == (np.arange(1000) < 600)) > 0.95


def risk(model, good, mixed):
    """The non-negative risk with its ridge, term by term."""
    g = lambda rows: (rows - model.mean) / model.spread @ model.weights + model.offset
    loss = lambda z: np.mean((1 - z) ** 2) / 4
    bad = loss(-g(mixed)) - model.prior * loss(-g(good))
    return model.prior * loss(g(good)) + max(0, bad) + quality.RIDGE / 4 * np.sum(model.weights**2)


def test_the_fit_minimises_the_non_negative_risk():
    random = np.random.default_rng(5)
    for prior in (0.2, 0.6, 0.9):  # where the held part is free, at zero or held, by turns
        good = random.normal(0.7, 1, (60, 8))
        mixed = np.concatenate([random.normal(0.7, 1, (70, 8)), random.normal(-0.7, 1, (50, 8))])
        model = quality.fit_positive_unlabelled(good, mixed, prior)
        least = risk(model, good, mixed)
        for size in (0.3, 0.03, 0.003):
            for _ in range(200):
                moved = dataclasses.replace(
                    model, weights=model.weights + random.normal(0, size, 8), offset=model.offset + random.normal(0, size)
                )
                assert risk(moved, good, mixed) >= least - 1e-9


def test_the_prior_is_estimated_without_negative_labels(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    model = quality.train(docs, labels)
    known = [q for _, q in rows(MEDIUM, "SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL")]
    assert abs(model.prior - np.mean(np.array(known) == 1)) < 0.1
    alone = quality.train(docs, labels.filter("quality = 1"))
    assert np.allclose(alone.weights, model.weights) and np.isclose(alone.prior, model.prior)


def test_every_row_takes_part_in_the_fit(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").repartition(5)
    model = quality.train(docs, spark.read.parquet(f"{MEDIUM}/labels.parquet"))
    good = {k for k, least in rows(MEDIUM, "SELECT doc_id, min(quality) FROM labels GROUP BY doc_id") if least == 1}
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    mixed = np.stack([quality.features(t) for _, t in texts]).astype(np.float64)
    trusted = mixed[[k in good for k, _ in texts]]
    plain = quality.fit_positive_unlabelled(trusted, mixed, model.prior)
    assert np.allclose(plain.mean, model.mean) and np.allclose(plain.spread, model.spread)
    found = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, model).collect()}
    assert np.allclose([found[k] for k, _ in texts], plain.scores(mixed), atol=1e-6)


def test_the_prior_of_known_mixtures():
    random = np.random.default_rng(9)
    for share in (0.1, 0.5, 0.9):
        good = random.normal(1, 1, 20000)
        mixed = np.concatenate([random.normal(1, 1, int(20000 * share)), random.normal(-4, 1, int(20000 * (1 - share)))])
        seen = [np.histogram(x, 4000, (-9, 9))[0] for x in (good, mixed)]
        assert abs(quality.share_of_good(*seen) - share) < 0.03
    assert quality.share_of_good(np.zeros(4), np.ones(4)) == 0.5


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame(
        [(5, 1), (5, 1), (7, 1), (7, 0), (None, 1), (8, None), (8, 1), (99, 1)],
        "doc_id long, quality int",
    )
    found = quality.score_documents(docs, quality.train(docs, labels))
    assert found.count() == docs.count()
    assert found.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.train(docs, labels.limit(0)) is None
    assert quality.score_documents(docs, None).filter("score <> 0.5").count() == 0
    assert quality.score_documents(empty(spark), None).count() == 0
    assert quality.train(empty(spark), labels) is None


def test_only_labels_of_the_learning_folds_are_read(spark):
    from martflow.llm.common import in_held_out

    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    folds = labels.select(in_held_out(F.col("doc_id")).alias("held"), "doc_id").collect()
    import zlib

    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in folds)


FOREIGN = (
    "Wczoraj wieczorem poszliśmy z przyjaciółmi do teatru, żeby obejrzeć nową sztukę o życiu w małym miasteczku.",
    "Eilen illalla menimme ystävien kanssa teatteriin katsomaan uutta näytelmää pienen kaupungin elämästä.",
    "Dün akşam arkadaşlarla küçük bir kasabadaki yaşamı anlatan yeni oyunu izlemek için tiyatroya gittik.",
    "Tegnap este a barátainkkal színházba mentünk, hogy megnézzük az új darabot a kisváros életéről.",
    "aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Qgb2YgYmFzZTY0IGVuY29kaW5nIHdpdGggc29tZSBsZW5ndGg9PQ8xZk3QpLz",
)


def test_latin_and_encoded_texts_of_any_length_are_rejected(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language_id.train(docs.filter("doc_id % 5 <> 0"))
    texts = [t for text in FOREIGN for t in (text[:60], text, f"{text} {text[::-1]} " * 20)]
    other = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = language_id.identify_languages(other, model)
    assert [r["text"] for r in found.filter("NOT rejected").join(other, "doc_id").collect()] == []


def test_rejections_of_held_out_texts_are_few_at_any_length(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").filter("length(text) > 100")
    model = language_id.train(docs.filter("doc_id % 5 <> 0"))
    held = docs.filter("doc_id % 5 = 0")
    for size in (60, 200, 1000, 1 << 30):
        found = language_id.identify_languages(held.withColumn("text", F.substring("text", 20, size)), model)
        assert found.filter("rejected").count() <= 0.02 * found.count()
