"""Run ledger: one appended row per finished run.

Appending that row is what makes a run count.  The cursor, the volume history
and the last run's summary are queries over the ledger, so they cannot disagree.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..operators import CheckResult
from ..sources import read_if_present

# Run statuses and modes.
SUCCESS = "success"
NO_NEW_DATA = "no_new_data"
INCREMENTAL = "incremental"
FULL_REFRESH = "full_refresh"
#: A run over stored rejects that today's rules accept.  Its size is no usual volume.
REPLAY = "replay"

#: Written before a run starts to replace mart days.  Without a finished row of the same
#: number, the run broke off there, and the next one has to make good what it left.
PUBLISHING = "publishing"

#: All batches so far have been merged into one folder of a new epoch.
COMPACTED = "compacted"

#: Days were made again because the looked-up dimension had changed; no batch came in.
DIMENSION_CHANGED = "dimension_changed"

#: A slice of a first load or refresh has been written.  It counts once the load's last row is in.
STAGED = "staged"

#: The slices of a load that broke off count no more; the load begins anew.
DISCARDED = "discarded"

#: The mart is again what it was before a run that broke off while it replaced days.
RESTORED = "restored"

CHECK_TYPE = StructType(
    [
        StructField("name", StringType()),
        StructField("passed", BooleanType()),
        StructField("detail", StringType()),
    ]
)

LEDGER_SCHEMA = StructType(
    [
        StructField("epoch", LongType()),
        StructField("run_seq", LongType()),
        StructField("batch_id", LongType()),
        StructField("status", StringType()),
        StructField("mode", StringType()),
        StructField("started_at", StringType()),
        StructField("duration_seconds", DoubleType()),
        StructField("rows_read", LongType()),
        StructField("rows_rejected", LongType()),
        StructField("rows_unreadable", LongType()),
        StructField("rows_in_batch", LongType()),
        StructField("watermark_before", StringType()),
        StructField("watermark_after", StringType()),
        StructField("delivery", StringType()),
        StructField("dimension", LongType()),
        StructField("sides", ArrayType(StringType())),
        StructField("rules", StringType()),
        StructField("checks", ArrayType(CHECK_TYPE)),
    ]
)


@dataclass(frozen=True)
class RunRecord:
    epoch: int
    run_seq: int
    batch_id: int | None
    status: str
    mode: str
    started_at: str
    duration_seconds: float
    rows_read: int
    rows_rejected: int
    rows_in_batch: int
    watermark_before: str | None
    watermark_after: str | None
    #: Rows of the whole scan whose time cannot be read; no cursor can place them.
    rows_unreadable: int = 0
    #: What a stream calls the files it handed over, so that a second time is noticed.
    delivery: str | None = None
    #: The stored dimension that the mart's days show, once this row is in.
    dimension: int | None = None
    #: Side tables that hold this batch.
    sides: Sequence[str] = ()
    #: The version of the rules by which a slice was written.
    rules: str | None = None
    checks: Sequence[CheckResult] = ()


@dataclass(frozen=True)
class Slice:
    """What a written slice of a load holds; ``watermark_after`` is its newest time."""

    batch_id: int
    watermark_after: str
    rows_read: int
    rows_rejected: int
    rows_unreadable: int
    rows_in_batch: int
    rules: str


@dataclass(frozen=True)
class LedgerState:
    """Where the next run starts.  ``epoch`` is 0 before the first successful run.

    ``open_epoch`` and ``open_batch`` name a batch whose run broke off after it had begun
    to replace mart days.  ``volumes`` are the batch sizes of the epoch, oldest first.
    ``slices`` are those of a load that is not finished, oldest first.
    """

    epoch: int = 0
    last_batch: int = 0
    last_run: int = 0
    cursor: str | None = None
    open_epoch: int | None = None
    open_batch: int | None = None
    volumes: tuple[int, ...] = ()
    delivered: bool = False
    #: The stored dimension that the mart shows, and the one that an open run was showing.
    dimension: int | None = None
    open_dimension: int | None = None
    #: Side tables that hold every batch of the epoch.
    sides: frozenset[str] = frozenset()
    slices: tuple[Slice, ...] = ()

    @property
    def refresh_broke_off(self) -> bool:
        return self.epoch > 0 and (self.open_epoch or 0) > self.epoch


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All recorded runs; empty before the first.  Unreadable lines are left out."""
    return read_if_present(spark, path, LEDGER_SCHEMA, "json").filter(F.col("run_seq").isNotNull())


def append_run(spark: SparkSession, path: str, record: RunRecord) -> None:
    row = F.from_json(F.lit(json.dumps(asdict(record))), LEDGER_SCHEMA)
    one = spark.range(0, 1, numPartitions=1).select(F.inline(F.array(row)))
    one.write.mode("append").json(path)


def _succeeded() -> Column:
    return F.col("status") == SUCCESS


def current_runs(runs: DataFrame) -> DataFrame:
    """Successful runs since the last full rebuild, that one included."""
    done = runs.filter(_succeeded())
    rebuilt = F.max(F.when(F.col("mode") == FULL_REFRESH, F.col("run_seq")))
    return done.filter(F.col("run_seq") >= F.coalesce(done.agg(rebuilt).scalar(), F.lit(0)))


def stored_cursor(runs: DataFrame) -> DataFrame:
    """One row: the cursor of the newest successful run, null before the first."""
    return current_runs(runs).agg(F.max_by("watermark_after", "run_seq").alias("watermark"))


def volume_history(runs: DataFrame, lookback: int | None = None) -> DataFrame:
    """Batch sizes of the successful runs, oldest first; the newest ``lookback`` if given."""
    sizes = current_runs(runs).filter(F.col("mode") != REPLAY).select("run_seq", "rows_in_batch")
    if lookback is not None:
        sizes = sizes.orderBy(F.desc("run_seq")).limit(lookback)
    return sizes.orderBy("run_seq")


def last_run(runs: DataFrame) -> DataFrame:
    """The newest finished run; no row before the first."""
    own = F.col("status").isin(PUBLISHING, COMPACTED, RESTORED, STAGED, DISCARDED)
    return runs.filter(~own).orderBy(F.desc("run_seq")).limit(1)


def slice_checks(runs: DataFrame, epoch: int, run_seq: int) -> DataFrame:
    """Check names of a load's slices, whether all passed, and in how many slices, in order."""
    own = runs.filter((F.col("status") == STAGED) & (F.col("epoch") == epoch) & (F.col("run_seq") == run_seq))
    each = own.select(F.posexplode("checks").alias("place", "c"))
    found = each.groupBy(F.col("c.name").alias("name")).agg(
        F.bool_and("c.passed").alias("passed"), F.count(F.lit(1)).alias("slices"), F.min("place").alias("place")
    )
    return found.orderBy("place")


def ledger_state(runs: DataFrame, delivery: str | None = None) -> LedgerState:
    """The ledger reduced to one row, with one number for each successful run."""
    confirmed = F.col("status").isin(SUCCESS, COMPACTED)
    pair = F.when(confirmed, F.struct("epoch", "batch_id", "run_seq", "watermark_after"))
    begun = F.when(F.col("status") == PUBLISHING, F.struct("run_seq", "epoch", "batch_id", "dimension"))
    rebuilt = F.max(F.when(_succeeded() & (F.col("mode") == FULL_REFRESH), F.col("run_seq")))
    size = F.when(_succeeded() & (F.col("mode") != REPLAY), F.struct("run_seq", "rows_in_batch"))
    finished = ~F.col("status").isin(PUBLISHING, STAGED)
    parts = [field.name for field in fields(Slice)]
    staged = F.when(F.col("status") == STAGED, F.struct("run_seq", "epoch", F.struct(*parts).alias("slice")))
    row = runs.agg(
        F.max(pair).alias("newest"),
        F.max(F.when(finished, F.col("run_seq"))).alias("last_run"),
        F.max(begun).alias("begun"),
        F.max(F.when(finished, F.struct("run_seq", "dimension"))).alias("shown"),
        F.collect_list(F.when(confirmed, F.struct("epoch", "sides"))).alias("sides"),
        F.sort_array(F.collect_list(size)).alias("sizes"),
        F.collect_list(staged).alias("staged"),
        rebuilt.alias("rebuilt"),
        F.bool_or(finished & (F.col("delivery") == F.lit(delivery))).alias("delivered"),
    ).first()
    newest, begun, last = row["newest"], row["begun"], row["last_run"] or 0
    epoch = newest["epoch"] if newest else 0
    sides = [frozenset(s["sides"] or ()) for s in row["sides"] if s["epoch"] == epoch]
    # Slices are of use as long as no other run has come between.
    slices = [
        Slice(**s["slice"].asDict()) for s in row["staged"] if (s["run_seq"], s["epoch"]) == (last + 1, epoch + 1)
    ]
    still_open = begun is not None and (begun["run_seq"] > last or begun["epoch"] > epoch)
    return LedgerState(
        epoch=epoch,
        last_batch=newest["batch_id"] if newest else 0,
        last_run=last,
        cursor=newest["watermark_after"] if newest else None,
        open_epoch=begun["epoch"] if still_open else None,
        open_batch=begun["batch_id"] if still_open else None,
        volumes=tuple(
            s["rows_in_batch"] for s in row["sizes"] if s["run_seq"] >= (row["rebuilt"] or 0)
        ),
        delivered=bool(row["delivered"]),
        dimension=row["shown"]["dimension"] if row["shown"] else None,
        open_dimension=begun["dimension"] if still_open else None,
        sides=frozenset.intersection(*sides) if sides else frozenset(),
        slices=tuple(sorted(slices, key=lambda s: s.batch_id)),
    )
