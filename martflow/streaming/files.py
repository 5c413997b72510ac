"""The incremental flow fed by newly arrived files instead of a rescan of the source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import Flow, FlowSpec
from ..sources import text_options


def run_new_files(
    spark: SparkSession,
    spec: FlowSpec,
    path: str,
    checkpoint: str,
    fmt: str = "csv",
    max_files: int | None = None,
    strict_header: bool = True,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Run ``spec`` over the files that arrived since the last call, then stop.

    ``spec.source`` is not used.  The stream remembers which files it has read, so no
    cursor bounds them: how files are dealt to micro-batches (``max_files``), and whether
    one is older than the last, makes no difference to the mart.  The ledger notes the
    stream's own number of each micro-batch, so one that Spark delivers twice changes
    nothing; rows that come again under another checkpoint are known by their versions.
    A failed check stops the query, and the next call gets the same files again.
    """
    reader = spark.readStream.schema(spec.contract.schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**text_options(strict_header, options))
    elif options:
        reader = reader.options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def run(batch: DataFrame, number: int) -> None:
        flow = Flow(batch.sparkSession, replace(spec, source=lambda _: batch))
        flow.run(delivery=f"{checkpoint}#{number}")

    return (
        reader.load(path)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
