"""File scans against a declared schema.  Types are never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class HeaderError(ValueError):
    """A file's header does not have the columns that its contract names."""


def text_options(strict_header: bool, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a CSV scan, for batch and stream alike."""
    own = {"header": "true", "enforceSchema": str(not strict_header).lower()}
    return {**own, **(options or {})}


def read_contract(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    fmt: str = "csv",
    strict_header: bool = True,
    optional: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Scan CSV, JSON, Parquet or ORC files with exactly ``schema``.

    CSV columns bind by the header's names.  A column that a header lacks is an error, or
    null if ``optional`` names it; columns beyond the schema are left out.  All files have
    to agree with the first one's header.  ``strict_header=False`` binds by position and
    does not look at headers.  Short lines are padded with nulls, and text that does not fit a
    column's type becomes null, for the validity rules to reject.  ``malformed`` names a
    further column that keeps the text of such lines (CSV and JSON).  ``options`` go to
    Spark's reader.
    """
    reader = spark.read.options(**(options or {}))
    wanted = StructType([*schema, StructField(malformed, StringType())]) if malformed else schema
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    if fmt != "csv":
        return reader.schema(wanted).format(fmt).load(path)
    reader = reader.options(**text_options(strict_header, options))
    if not strict_header:
        return reader.schema(wanted).csv(path)
    found = reader.csv(path).columns  # reads one line
    if missing := [c for c in schema.names if c not in found and c not in optional]:
        raise HeaderError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(found)}")
    typed = [StructField(c, schema[c].dataType if c in schema.names else StringType()) for c in found]
    rows = reader.schema(StructType([*typed, *wanted.fields[len(schema) :]])).csv(path)
    return rows.select(
        *(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted)
    )


def read_if_present(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    """Scan a dataset that may not have been written yet; absent reads as empty."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
