"""Language identification by nearest centroid over TF-IDF character n-grams.

A text becomes a vector of hashed byte 2- and 3-grams, letters in lower case, damped
counts times inverse document frequency, length one.  Each language has several centroids
from spherical k-means, so its kinds of text need not share one.  The nearest centroid by
cosine gives the language.  A text whose distance to it is beyond the reach of that
language's own training texts, and pieces of them, with about as many n-grams is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, release_memory, ship_package, unit_hash, utf8

UNKNOWN = "und"
DIMENSIONS = 1 << 12
CENTROIDS = 4
MOST_LANGUAGES = 1000  # bound of the model; more labels than that are refused
SAMPLE_PER_LANGUAGE = 1000  # bound of the rows that k-means sees, on average
FALSE_REJECTIONS = 0.004  # share of training texts and pieces of any length that the reach leaves out
PIECES = 10, 20, 40, 80, 160, 320, 640, 1280  # bytes; two pieces of each from every sampled text
KINDS = np.array([12, 24, 48, 96, 192, 384])  # different n-grams at which the next reach begins
#: Part of that cosine which is the reach: longer texts of a language are far nearer than foreign ones.
SHARES = np.array([1, 1, 1, 1, 1, 0.5, 0.5])
ROWS_AT_ONCE, BYTES_AT_ONCE = 256, 1 << 20

#: Upper-case letters as lower-case ones, digits as one sign, other ASCII signs as space.
FOLD = np.arange(256, dtype=np.uint32)
FOLD[65:91] += 32
FOLD[:48] = 32
FOLD[48:58] = 48
FOLD[58:65] = FOLD[91:97] = FOLD[123:128] = 32


def ngram_counts(text: bytes) -> np.ndarray:
    """Counts of hashed byte 2- and 3-grams of a whole text, in blocks."""
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(text), BYTES_AT_ONCE):
        block = np.frombuffer(text, np.uint8, min(BYTES_AT_ONCE + 2, len(text) - at), at)
        x = FOLD[block]
        x = x[(x != 32) | np.concatenate([[True], x[:-1] != 32])]  # one space for a run
        two = x[:-1] | (x[1:] << 8)
        three = two[:-1] | (x[2:] << 16)
        for code in (two | np.uint32(1 << 24), three):
            slots = (code * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(slots, minlength=DIMENSIONS)
    return counts


def unit_vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    rows = np.empty((len(texts), DIMENSIONS), np.float32)
    for row, text in zip(rows, texts):
        row[:] = ngram_counts(text)
    np.log1p(rows, out=rows)  # in place: the rows of a k-means are many
    rows *= idf
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    rows /= np.where(norm > 0, norm, 1)
    return rows


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit rows; starts from the row nearest the mean, then the farthest ones."""
    mean = rows.mean(0)
    centres = [rows[int(np.argmax(rows @ mean))]]
    near = rows @ centres[0]
    while len(centres) < min(k, len(rows)):
        centres.append(rows[int(np.argmin(near))])
        near = np.maximum(near, rows @ centres[-1])
    centres = np.stack(centres)
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        for c in range(len(centres)):
            if (mine := own == c).any():
                centre = rows[mine].sum(0)
                centres[c] = centre / max(np.linalg.norm(centre), 1e-9)
    return centres


def pieces_of(texts: list[bytes]) -> list[bytes]:
    """The texts, and from each longer one the beginning and the middle of every length."""
    pieces = list(texts)
    for size in PIECES:
        for text in texts:
            if len(text) > size:
                pieces += [text[:size], text[(len(text) - size) // 2 :][:size]]
    return pieces


def kind_of(vectors: np.ndarray) -> np.ndarray:
    """Which reach applies to each text, by the number of its different n-grams."""
    return np.searchsorted(KINDS, np.count_nonzero(vectors, axis=1), side="right")


def reaches(texts: list[bytes], centres: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The least cosine to accept for each kind, from the training texts of a language."""
    kinds, cosines, pieces = [], [], pieces_of(texts)
    for at in range(0, len(pieces), ROWS_AT_ONCE):
        vectors = unit_vectors(pieces[at : at + ROWS_AT_ONCE], idf)
        kinds.append(kind_of(vectors))
        cosines.append((vectors @ centres.T).max(1))
    kinds, cosines = np.concatenate(kinds), np.concatenate(cosines)
    reach = np.zeros(len(KINDS) + 1)
    for kind in range(len(reach)):
        own = cosines[kinds == kind]
        # Longer texts are nearer, so a kind without examples may use the reach before it.
        reach[kind] = np.quantile(own, FALSE_REJECTIONS) if len(own) else reach[max(kind - 1, 0)]
    return np.maximum.accumulate(reach * SHARES)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray
    reach: np.ndarray  # least cosine that each centroid accepts, by kind
    idf: np.ndarray

    def nearest(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroid and cosine for each text, and whether it is beyond the centroid's reach."""
        vectors = unit_vectors(texts, self.idf)
        cosine = vectors @ self.centroids.T
        best = np.argmax(cosine, axis=1)
        cosine = np.clip(cosine[np.arange(len(best)), best], 0, 1)
        return best, cosine, cosine < self.reach[best, kind_of(vectors)]


def _document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and rows with each n-gram slot, over all of ``texts``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                seen += ngram_counts(text.as_py()) > 0
                rows += 1
        slots = pa.array(np.arange(-1, DIMENSIONS), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [slots, pa.array(np.concatenate([[rows], seen]), pa.int64())], ["slot", "rows"]
        )

    counts = map_batches(texts, counted, "slot int, rows long")
    summed = counts.groupBy("slot").agg(F.sum("rows").alias("rows"))
    found = {row["slot"]: row["rows"] for row in summed.collect()}  # one row per slot
    return found.get(-1, 0), np.array([found.get(s, 0) for s in range(DIMENSIONS)], np.float64)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE_PER_LANGUAGE,
    centroids: int = CENTROIDS,
) -> LanguageModel | None:
    """Learn from all labelled rows given; None if none has a language and a letter.

    Document frequencies come from every row.  The centroids come from about ``sample``
    rows of each language, chosen by a hash of the id, which bounds each k-means.
    """
    ship_package(docs.sparkSession)
    rows = docs.filter(F.col(lang_col).isNotNull() & has_letter(F.col(text_col))).select(
        F.col(lang_col).cast("string").alias("lang"),
        utf8(F.col(text_col)).alias("text"),
        unit_hash(F.col(id_col).cast("string"), F.col(text_col), F.lit("language sample")).alias("luck"),
    )
    total, frequency = _document_frequencies(rows.select("text"))
    if not total:
        return None
    idf = (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32)
    sizes = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values")
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], sample / r["count"])))
    chosen = rows.filter(F.col("luck") < F.element_at(share, F.col("lang"))).select("lang", "text")

    def clustered(group: pd.DataFrame) -> pd.DataFrame:
        texts = [bytes(t) for t in group["text"]]
        centres = spherical_kmeans(unit_vectors(texts, idf), centroids).astype(np.float32)
        reach = reaches(texts, centres, idf)
        release_memory()
        return pd.DataFrame({
            "lang": group["lang"].iloc[0],
            "part": range(len(centres)),
            "centre": [c.tobytes() for c in centres],
            "reach": [reach.tobytes()] * len(centres),
        })

    # A few centroids for each language come back, whatever the number of documents.
    found = (
        chosen.groupBy("lang")
        .applyInPandas(clustered, "lang string, part int, centre binary, reach binary")
        .collect()
    )
    found = sorted(found, key=lambda r: (r["lang"], r["part"]))
    if not found:
        return None
    return LanguageModel(
        tuple(r["lang"] for r in found),
        np.stack([np.frombuffer(r["centre"], np.float32) for r in found]),
        np.stack([np.frombuffer(r["reach"]) for r in found]),
        idf,
    )


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def language_column(spark: SparkSession, model: LanguageModel | None, text: Column) -> Column:
    """``lang_pred, score, rejected`` of a text, as one struct.

    ``lang_pred`` is the nearest centroid's language and ``score`` its cosine.  A text
    that is null or has no letter, and any text without a model, is ``und`` with score 0
    and rejected.  A text beyond the reach of its language is rejected too, and keeps
    ``lang_pred`` as the best guess.
    """
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # a few vectors for each language

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def language(column: pa.Array) -> pa.Array:
        known, rows = shared.value, len(column)
        langs, scores, out = [UNKNOWN] * rows, [0.0] * rows, [True] * rows
        readable = np.flatnonzero(column.is_valid()) if known is not None else np.empty(0, np.int64)
        for at in range(0, len(readable), ROWS_AT_ONCE):
            some = readable[at : at + ROWS_AT_ONCE]
            texts = column.take(pa.array(some)).to_pylist()
            for k, best, cosine, beyond in zip(some.tolist(), *known.nearest(texts)):
                langs[k], scores[k], out[k] = known.languages[best], float(cosine), bool(beyond)
        release_memory()
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(out, pa.bool_())],
            ["lang_pred", "score", "rejected"],
        )

    return language(F.when(has_letter(text), utf8(text)))


def identify_languages(
    docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, rejected``, one row for each row of ``docs``.

    Repeated rows get the same answer; an empty table gives no rows.
    """
    found = language_column(docs.sparkSession, model, F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), found.alias("found")).select("doc_id", "found.*")


def drop_unidentified(
    docs: DataFrame, model: LanguageModel | None, text_col: str = "text"
) -> DataFrame:
    """The rows whose language is not rejected, with all their columns."""
    return docs.filter(~language_column(docs.sparkSession, model, F.col(text_col))["rejected"])
