"""From raw documents to packed training sequences, in five written stages.

Each stage reads what the one before it wrote, so a lost executor or a restarted job
repeats one stage at most.  All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import language_id
from martflow.llm.common import in_held_out, table
from martflow.llm.decontamination import drop_leaks
from martflow.llm.line_dedup import drop_repeated_runs
from martflow.llm.packing import pack_documents
from martflow.llm.simhash import drop_near_duplicates
from martflow.plans.scratch import scratch_folder, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those far from every known language."""
    model = language_id.train(docs.filter(~in_held_out(F.col("doc_id"))))
    return language_id.drop_unidentified(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated runs of lines; every document stays."""
    clean = drop_repeated_runs(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates."""
    return drop_near_duplicates(docs, words_in_shingle=4, distance=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences: one row for each piece of a document."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Trained models and token ids cannot be written as SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the session's scratch folder."""
    folder = scratch_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}-{name}")
    return docs
