"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import free_names as free_names  # for the modules beside this one

#: Rows whose crc32(id) leaves this remainder are never learned from.
HELD_OUT_FOLD, FOLDS = 0, 5


def in_held_out(key: Column) -> Column:
    """Whether a row belongs to the held-out fold.  A null id counts as held out."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT_FOLD


def utf8(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def unit_hash(*columns: Column) -> Column:
    """A stable number in (0, 1) from the columns' values."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release_memory() -> None:
    """Give the system what Arrow's allocator keeps for later.

    Python workers stay for later tasks, and what theirs needed once adds to the memory of
    every other stage.
    """
    pa.default_memory_pool().release_unused()


Batches = Iterator[pa.RecordBatch]


def map_batches(rows: DataFrame, work: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow``, whose workers hold no more memory after a task than before it."""

    def released(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return rows.mapInArrow(released, schema)


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Make this package importable for the executors' Python workers, once a session.

    The archive stays on the driver, which serves it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="package-")
    archive = f"{folder.name}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED[context.applicationId] = folder
