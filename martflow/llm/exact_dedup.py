"""Exact duplicates by content sort.

Splitters are sampled from bounded sort keys (the text's first bytes, its digest, its
id); rows are range-partitioned by them and sorted externally, which puts equal texts
next to each other.  Neighbours are then compared byte for byte.  Because the id is part
of the key, a text that a third of all rows share is cut over many partitions; the runs
at partition borders, two in each, are joined afterwards by their full texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import free_names, shuffle_partitions, ship_package

PREFIX_CHARS = 32
HELD_ROWS = 1 << 16  # of one run of equal texts, that a task holds before it writes them

RUNS = (
    "doc_id long, text_sha256 string, head long, first boolean, rows long, "
    "edge_text binary, part int, run long, summary boolean"
)
RUN_TYPES = pa.schema([
    ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("head", pa.int64()),
    ("first", pa.bool_()), ("rows", pa.int64()), ("edge_text", pa.binary()), ("part", pa.int32()),
    ("run", pa.int64()), ("summary", pa.bool_()),
])


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _runs(batches: Iterator[pa.RecordBatch], held: int = HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """Compare neighbours of a sorted partition and describe the runs of equal texts.

    A run within the partition has its size in each row.  A run at one of the partition's
    ends, and one of more than ``held`` rows, leaves the size open and has a summary row.
    """
    part = TaskContext.get().partitionId()
    text, digest, head, run, size, ids = None, None, None, 0, 0, []

    def rows(whole: bool) -> list[tuple]:
        begun = size - len(ids)  # rows of this run that are out already
        total = size if whole else None
        return [
            (key, digest, head, begun + k == 0, total, None, part, run, False)
            for k, key in enumerate(ids)
        ]

    def closed(last: bool) -> list[tuple]:
        whole = size == len(ids) and not (run == 0 or last)
        summary = (None, digest, head, True, size, text, part, run, True)
        return rows(whole) + ([] if whole else [summary])

    for batch in batches:
        done: list[tuple] = []
        for key, sha, own in zip(*(c.to_pylist() for c in batch.columns)):
            if size and own != text:
                done += closed(False)
                ids, run, size = [], run + 1, 0
            if not size:
                text, digest, head = own, sha, key
            ids.append(key)
            size += 1
            if len(ids) > held:
                done += rows(False)
                ids = []
        if done:
            yield _batch(done)
    if size:
        yield _batch(closed(True))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, RUN_TYPES)], schema=RUN_TYPES
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: int = HELD_ROWS
) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    ``doc_id, keep_id, group_size, kept, text_sha256``.  Texts are equal if they are
    after ``normalised``; null counts as empty.  The smallest id stays, a null id only
    if there is no other.  Of rows that repeat an id and a text, one is kept.  An empty
    table gives an empty table; other columns are not read.  A task holds one text and up to
    ``held`` ids, however many rows share it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm")
    )
    rows = rows.select(
        "doc_id",
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.col("norm").cast("binary").alias("norm"),
        F.substring("norm", 1, PREFIX_CHARS).alias("prefix"),
    )
    key = ["prefix", "text_sha256", F.col("doc_id").asc_nulls_last()]
    runs = (
        rows.repartitionByRange(shuffle_partitions(spark), *key)
        .sortWithinPartitions("prefix", "text_sha256", "norm", F.col("doc_id").asc_nulls_last())
        .select("doc_id", "text_sha256", "norm")
        .mapInArrow(lambda batches: _runs(batches, held), RUNS)
    )
    runs = written(runs, f"{scratch_folder(spark)}/runs")
    return _joined_at_edges(runs)


def _joined_at_edges(runs: DataFrame) -> DataFrame:
    same = Window.partitionBy("text_sha256", "edge_text")
    open_runs = runs.filter("summary").select(
        "part",
        "run",
        F.min_by("head", "part").over(same).alias("edge_keep"),
        F.sum("rows").over(same).alias("edge_rows"),
        (F.min("part").over(same) == F.col("part")).alias("edge_first"),
    )
    # Two rows at most for each sorted partition, and one for every HELD_ROWS documents.
    joined = runs.filter("NOT summary").join(F.broadcast(open_runs), ["part", "run"], "left")
    return joined.select(
        "doc_id",
        F.when(F.col("rows").isNull(), F.col("edge_keep")).otherwise(F.col("head")).alias("keep_id"),
        F.coalesce("rows", "edge_rows").alias("group_size"),
        (F.col("first") & F.coalesce("edge_first", F.lit(True))).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows are matched by id, so rows that share an id stay or go together.
    """
    (own,) = free_names(docs.columns, "kept_id")
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias(own))
    return docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(own)), "left_semi")
