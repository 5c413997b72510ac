"""Side tables of the fact layer: a folder for each batch, split by a hash of some columns.

A reader that looks for given values reads the buckets of these values and no others.
Batch folders are overwritten whole, like those of the fact layer, so what a broken-off
run left is never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions import free_names
from ..sources import read_if_present
from .publish import BATCH, epoch_folder


class SideTable:
    """Rows of ``schema`` by batch, in ``buckets`` by a hash of ``columns``."""

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, columns: Sequence[str], buckets: int
    ):
        if buckets < 1:
            raise ValueError("a side table needs at least one bucket")
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.columns, self.buckets = [*columns], buckets
        self.bucket, self.batch = free_names(schema.names, "key_bucket", BATCH)

    @property
    def name(self) -> str:
        """What the ledger calls the table: batches with another name were laid out otherwise."""
        return f"{self.root.rsplit('.', 1)[-1]}({','.join(self.columns)})/{self.buckets}"

    def bucket_of(self, columns: Sequence[str]) -> Column:
        # A null value has a bucket like any other.
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def add(self, rows: DataFrame, epoch: int, batch: int) -> None:
        """Write the rows of a batch, in place of what it had."""
        (
            rows.select(*self.schema.names)
            .withColumn(self.bucket, self.bucket_of(self.columns))
            .hint("rebalance", F.col(self.bucket))
            .sortWithinPartitions(self.bucket, *self.columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(self.bucket)
            .parquet(f"{epoch_folder(self.root, epoch)}/{self.batch}={batch}")
        )

    def read(
        self, epoch: int, last: int, values: DataFrame | None = None, numbers: Sequence[int] | None = None
    ) -> DataFrame:
        """Rows of an epoch up to batch ``last``; with ``values``, those of their buckets only.

        ``values`` has the bucketed columns and should be written.  The numbers of their
        buckets come to the driver, which are ``buckets`` at most, unless ``numbers`` gives
        them; folders of the others are not even listed.
        """
        base = epoch_folder(self.root, epoch)
        path = base
        if values is not None:
            found = values.select(self.bucket_of(self.columns).alias(self.bucket)).distinct().collect()
            numbers = [row[0] for row in found]
        if numbers is not None:
            if not numbers:
                return self.spark.createDataFrame([], self.schema)
            path = f"{base}/{self.batch}=*/{self.bucket}={{{','.join(map(str, sorted(numbers)))}}}"
        laid_out = StructType([
            *self.schema, StructField(self.batch, LongType()), StructField(self.bucket, IntegerType())
        ])
        try:
            rows = self.spark.read.schema(laid_out).option("basePath", base).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        return rows.filter(F.col(self.batch) <= last).select(*self.schema.names)

    def read_batch(self, epoch: int, batch: int) -> DataFrame:
        """The rows of one batch; lists that batch's folder only."""
        folder = f"{epoch_folder(self.root, epoch)}/{self.batch}={batch}"
        return read_if_present(self.spark, folder, self.schema, "parquet")

    def numbers(self, epoch: int, batch: int) -> list[int]:
        """The buckets that a batch has rows in, by its folders."""
        laid_out = StructType([*self.schema, StructField(self.bucket, IntegerType())])
        folder = f"{epoch_folder(self.root, epoch)}/{self.batch}={batch}"
        rows = read_if_present(self.spark, folder, laid_out, "parquet")
        return [row[0] for row in rows.select(self.bucket).distinct().collect()]

    def retire(self, epoch: int) -> None:
        """Drop the files of an epoch, by overwriting its folder with no rows."""
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            epoch_folder(self.root, epoch)
        )


def key_days(spark: SparkSession, clean: str, what: str, schema: StructType, columns: Sequence[str], day: str, buckets: int) -> SideTable:
    """The index from keys to days of a fact layer: distinct (key, day) pairs."""
    fields = StructType([schema[c] for c in dict.fromkeys([*columns, day])])
    return SideTable(spark, f"{clean.rstrip('/')}.{what}", fields, columns, buckets)


def days_in(index: SideTable, keys: DataFrame, day: str, epoch: int, last: int) -> DataFrame:
    """Distinct days of ``keys``, which are written and have the index's columns."""
    rows = index.read(epoch, last, keys)
    return rows.join(keys.select(*index.columns), index.columns, "left_semi").select(day).distinct()
