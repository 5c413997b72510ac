"""Small tables with awkward rows, and plain versions of what operators compute."""

from __future__ import annotations

import duckdb

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Names that operators use for their own columns.
CLASHING = [
    "shard", "slot", "part", "order", "code", "rank", "idx", "score", "lang_pred", "kept",
    "leak_id", "cut_id", "cut_spans", "weight", "lines", "words", "text_key",
    "kept_id", "_kept_id", "__kept_id", "component_id", "fingerprint", "node", "root", "keep_id",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(folder: str, sql: str) -> list[tuple]:
    db = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db.execute(sql).fetchall()


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated ids and rows."""
    long_text = "\n".join(f"line {k} " + "word " * 60 + str(k) for k in range(3000))
    passage = " ".join(f"shared{k}" for k in range(60))
    given = [
        (None, None, None, None, None),
        (None, "No id here, but a text of some words.", "en", "a", 1),
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, "", "fr", "b", 0),
        (4, " \n\t \n", "fr", "b", 5),
        (5, long_text, "en", "a", len(long_text)),
        (6, long_text, "en", "a", len(long_text)),
        (7, "The same row twice, word for word.", "en", "a", 3),
        (7, "The same row twice, word for word.", "en", "a", 3),
        (7, "The same id with another text.", "en", "a", 3),
        (8, f"first line\n{passage}\nlast line", "en", "a", 3),
        (9, f"{passage}\n\nother end", "de", "a", 3),
        (None, passage, "de", "a", 3),
        (10, "x" * 300_000, None, "a", 3),
        (11, "1234 5678 !!", "es", "a", 3),
        (13, "\n" * 1_100_000, None, "a", 3),
        (14, " " * 1_100_000 + "end", None, "a", 3),
        (12, "L'été déjà là, naïve œuvre\r\nŒUVRE", "fr", "a", 3),
    ]
    docs = spark.createDataFrame(given, SCHEMA)
    for name in CLASHING:
        docs = docs.withColumn(name, docs["doc_id"] * 0 + 7)
    return docs


def empty(spark):
    return awkward(spark).limit(0)
