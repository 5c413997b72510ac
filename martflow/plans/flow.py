"""The incremental flow: select, clean, write, audit, publish, record.

Order of a run, and why a run that breaks off anywhere can be repeated:

1. One pass over the new source rows finds the next cursor and the counts.
2. Valid, deduplicated rows go to the batch's own folder, and what the checks count row by
   row is counted on the way.  Nothing reads the folder yet.
3. The other checks read that folder; a failure of any stops here.
4. A ledger row says that the mart is about to change.  The affected days are computed
   into a scratch table, then replaced.
5. One more ledger row is appended.  Only now does the batch count.

A run that finds step 4 begun and step 5 missing first makes those days again what the
confirmed batches say, and notes that.  A rebuild that broke off is repeated; should its
checks fail, the mart is made again what it was.

A mart with a lookup shows a stored state of its dimension, which the ledger names.  Each run
stores the dimension as it is now and compares; days with facts of changed keys are made
again with the batch, or on their own where nothing else is new.

A first load or refresh may go in slices of whole days.  Each is written and checked on its
own and gets a ledger row, which readers do not look at; the row that ends the load makes
them all count at once.  A load that broke off goes on behind its last slice.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from statistics import median

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, StructType

from ..functions import time_literal, time_text, time_type
from ..operators import (
    DAILY_CATEGORY_MART,
    BatchRejected,
    CheckPlan,
    CheckResult,
    MartSpec,
    Money,
    Reference,
    affected_days,
    audit,
    build_mart,
    current_rows,
    days_of_keys,
    days_of_some_keys,
    dimension_changes,
    gate,
    high_mark,
    is_rejected,
    latest_per_key,
    not_known,
    one_row_per_key,
    parse_time,
    rejected_rows,
    rows_after,
    scan_counts,
    touched_days,
    valid_rows,
)
from ..sources import CUSTOMERS_SCHEMA, ORDERS, Contract, FiniteRule, Rule, read_contract
from . import ledger as runs
from . import publish
from .scratch import written
from .sides import days_in, key_days
from .state import MartState

#: Folders for stored dimensions: what the mart shows, what an open run showed, what is now.
DIMENSIONS = 3

#: Keys of a batch that the index finds without a shuffle of it.
FEW_KEYS = 100_000

Table = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class FlowSpec:
    """Everything a flow needs: tables in, paths out, rules, checks, measures.

    Paths must be on storage that all executors share.

    ``key_buckets`` keeps an index from keys to days beside the fact layer, in so many
    buckets: a correction then reads the buckets of its keys and not the whole history.
    ``differences`` maintains the mart by what a batch adds and supersedes; it needs the
    index, and a mart without a lookup.  Both begin with a first load, a full refresh or
    ``Flow.compact``; until then a flow works without them.

    ``slice_rows`` makes first loads and refreshes go in slices of whole days, each with
    about so many source rows (a day that holds more is one slice).
    """

    source: Table
    clean: str
    mart: str
    ledger: str
    contract: Contract
    mart_spec: MartSpec
    checks: CheckPlan = CheckPlan()
    dimension: Table | None = None
    rejects: str | None = None
    lookback: str | None = None
    key_buckets: int | None = None
    differences: bool = False
    slice_rows: int | None = None


def retail_spec(
    orders: str,
    customers: str,
    root: str,
    fmt: str = "csv",
    strict_header: bool = True,
    options: Mapping[str, str] | None = None,
    **changes,
) -> FlowSpec:
    """The orders and customers flow over files, with its outputs under ``root``.

    ``strict_header`` and ``options`` are those of ``read_contract``.  Customers may lack
    their sign-up date.
    """
    reading = dict(fmt=fmt, strict_header=strict_header, options=options)
    settings = dict(
        source=lambda spark: read_contract(spark, orders, ORDERS.schema, **reading),
        dimension=lambda spark: read_contract(
            spark, customers, CUSTOMERS_SCHEMA, optional=("signup_date",), **reading
        ),
        clean=f"{root}/clean/orders",
        mart=f"{root}/curated/daily_category_revenue",
        ledger=f"{root}/ledger",
        contract=ORDERS,
        mart_spec=DAILY_CATEGORY_MART,
        checks=RETAIL_CHECKS,
    )
    return FlowSpec(**{**settings, **changes})


RETAIL_CHECKS = CheckPlan(
    not_null=("order_id",),
    unique=("order_id",),
    non_negative=("unit_price",),
    reference=Reference("customer_id", "customer_id"),
)


class Flow:
    """Runs a ``FlowSpec`` and reads what it published.  One writer at a time."""

    def __init__(self, spark: SparkSession, spec: FlowSpec):
        contract, mart = spec.contract, spec.mart_spec
        if mart.day != contract.day or contract.day not in mart.grain:
            raise ValueError(f"the mart must be grouped by the contract's day, {contract.day}")
        if spec.dimension is None and (spec.checks.reference or mart.lookup):
            raise ValueError("a reference check or a lookup needs a dimension")
        self.spark = spark
        self.spec = spec
        empty = spark.createDataFrame([], contract.schema)
        kind = parse_time(empty, contract).schema[contract.day].dataType
        if not isinstance(kind, DateType):
            raise ValueError(f"{contract.day} must be a date, not {kind.simpleString()}")
        if spec.slice_rows is not None and spec.slice_rows < 1:
            raise ValueError("slice_rows must be at least 1")
        self.rules = (*contract.validity, *_finite_amounts(contract, mart))
        self.keys = self.looked_up = self.state = None
        if spec.key_buckets:
            self.keys = self._key_days("key_days", contract.key)
            if mart.lookup:
                self.looked_up = self._key_days("lookup_days", (mart.lookup.fact_key,))
        if spec.differences:
            if mart.lookup or not spec.key_buckets:
                raise ValueError("differences need a key index and a mart without a lookup")
            facts = spark.createDataFrame([], contract.clean_schema)
            self.state = MartState(spark, spec.mart, facts, mart, contract.key, spec.key_buckets)

    # -- reading -----------------------------------------------------------

    def ledger(self) -> DataFrame:
        return runs.read_ledger(self.spark, self.spec.ledger)

    def versions(self) -> DataFrame:
        """All confirmed fact rows, every version, with the batch each came in."""
        state = runs.ledger_state(self.ledger())
        return self._batches(state.epoch, state.last_batch)

    def clean(self) -> DataFrame:
        """All confirmed fact rows, every version."""
        return self.versions().drop(publish.BATCH)

    def current(self) -> DataFrame:
        """The latest version of each key over all confirmed batches."""
        contract = self.spec.contract
        return latest_per_key(self.clean(), contract.key, contract.time, contract.ties)

    def mart(self) -> DataFrame:
        """The published mart in grain order."""
        mart = publish.read_mart(self.spark, self.spec.mart, self._mart_schema())
        return mart.select(*self.spec.mart_spec.columns).orderBy(*self.spec.mart_spec.grain)

    # -- running -----------------------------------------------------------

    def run(
        self,
        full_refresh: bool = False,
        accept_volume: bool = False,
        delivery: str | None = None,
        mode: str = runs.INCREMENTAL,
        most_slices: int | None = None,
        resume: bool = True,
    ) -> runs.RunRecord:
        """Process what is new, or rebuild from all of the source.

        ``accept_volume`` lets one unusual batch size pass, after someone has
        looked at it.  A failed check raises ``BatchRejected`` and publishes
        nothing; what was published before stays readable, also in a rebuild.

        ``delivery`` names a source that holds new files only.  The cursor does not bound
        it, so rows that arrive late count, and a name the ledger knows changes nothing.
        ``mode`` is what the ledger calls a run that is no full refresh.

        A load in slices ends after ``most_slices`` of them, with the status ``staged``; the
        next run (of a refresh: the next ``full_refresh``) goes on from there, as it does
        after a load that broke off.  It begins anew without ``resume``, under other rules,
        or if another run has come between, which may have met rows that arrived late.
        """
        if most_slices is not None and most_slices < 1:
            raise ValueError("most_slices must be at least 1")
        begun = time.perf_counter()
        at = datetime.now(timezone.utc).replace(microsecond=0).isoformat()
        spec, contract = self.spec, self.spec.contract
        state = runs.ledger_state(self.ledger(), delivery)
        refresh = full_refresh or state.refresh_broke_off
        first = refresh or state.epoch == 0
        cursor = None if first else state.cursor

        def record(status: str, **facts) -> runs.RunRecord:
            done = runs.RunRecord(
                run_seq=state.last_run + 1,
                status=status,
                mode=runs.FULL_REFRESH if refresh else mode,
                started_at=at,
                duration_seconds=round(time.perf_counter() - begun, 3),
                watermark_before=cursor,
                delivery=delivery,
                **facts,
            )
            runs.append_run(self.spark, spec.ledger, done)
            return done

        nothing = dict(epoch=state.epoch, batch_id=None, rows_in_batch=0, watermark_after=cursor)
        unread = dict(rows_read=0, rows_rejected=0)
        if state.open_epoch is not None and not first:
            self._restore(state)
            record(runs.RESTORED, dimension=state.dimension, **unread, **nothing)
            state = replace(
                state, last_run=state.last_run + 1, open_epoch=None, open_batch=None, open_dimension=None
            )
        if state.delivered:
            return record(runs.NO_NEW_DATA, dimension=state.dimension, **unread, **nothing)
        sliced = first and bool(spec.slice_rows) and delivery is None
        if first and state.slices:
            if not (sliced and resume and {s.rules for s in state.slices} == {self.rule_version}):
                record(runs.DISCARDED, dimension=state.dimension, **unread, **nothing)
                state = replace(state, last_run=state.last_run + 1, slices=())
        shown = self._store_dimension(state)
        if sliced:
            slices, stopped = self._load_slices(state, record, accept_volume, most_slices)
            if stopped:
                return stopped
            if slices:  # else no row has a time, and the load is an ordinary one
                return self._publish_slices(state, slices, shown, record)
        changed = None if first else self._changed_keys(state.dimension, shown)
        new = self._new_rows(state, cursor, bounded=delivery is None)
        counts = self._profile(new, cursor, placed=delivery is None and cursor is not None)
        high = counts.pop("high")
        if high is None and not (refresh and state.epoch):
            dated = None if first else self._days_shown(changed, state, state.last_batch)
            if dated is None or dated.isEmpty():
                # The stored dimension may have changed all the same, in keys without facts.
                return record(runs.NO_NEW_DATA, dimension=state.dimension if first else shown, **counts, **nothing)
            facts = dict(nothing, dimension=shown, batch_id=state.last_batch, **counts)
            record(runs.PUBLISHING, **facts)
            self._replace_days(dated, self._batches(state.epoch, state.last_batch), shown)
            return record(runs.DIMENSION_CHANGED, **facts)

        epoch = state.epoch + 1 if first else state.epoch
        batch = 1 if first else state.last_batch + 1
        # A source that grows while the run reads it must not change the batch.
        seen = rows_after(new, None, contract.time, upto=high) if high else new.limit(0)
        measured = self._write_batch(seen, epoch, batch)
        if spec.rejects:
            self._write_rejects(new, high, epoch, batch)
        staged = publish.read_batch(self.spark, spec.clean, epoch, batch, contract)

        size, results = self._audit(staged, measured, accept_volume, () if first else state.volumes)
        try:
            gate(results)
        except BatchRejected:
            if state.open_epoch is not None and first:
                self._restore(state)
            raise

        state = replace(state, epoch=epoch, last_batch=batch - 1)
        sides = self._write_sides(staged, state, epoch, batch, first, keyed=True)
        facts = dict(
            epoch=epoch, batch_id=batch, rows_in_batch=size, watermark_after=high, dimension=shown,
            sides=[table.name for table in sides], **counts,
        )
        # Until the final row is in, the mart is ahead of the ledger.
        record(runs.PUBLISHING, **facts)
        if first:
            self._replace(staged, None, shown)  # one batch, already one row per key
        elif self.state in sides:
            self._replace_from_state(epoch, batch)
        else:
            self._replace_affected(staged, state, batch, shown, changed)
        done = record(runs.SUCCESS, checks=results, **facts)
        if refresh and state.epoch > 1:
            self._retire(state.epoch - 1)
        return done

    def rejects(self) -> DataFrame:
        """Stored rejects of all confirmed batches, with their batch, failed rules and rule version."""
        state = runs.ledger_state(self.ledger())
        return publish.read_rejects(
            self.spark, self._rejects_folder(), state.epoch, state.last_batch, self.spec.contract
        )

    def replay(self, accept_volume: bool = True) -> runs.RunRecord:
        """Publish the stored rejects that today's rules accept, as a batch of their own.

        The batch goes through checks, ledger and rebuild like any other, and the cursor
        stays.  A row that a known version of its key equals or beats changes nothing, so a
        second replay, or one after a run that broke off, adds nothing twice.  What the
        rules still reject stays where it is.  Rows whose time could not be read when they
        came in have none, and cannot come back this way.
        """
        state = runs.ledger_state(self.ledger())
        if state.refresh_broke_off or not state.epoch:
            raise ValueError("a replay needs a finished load; run the flow first")
        accepted = valid_rows(self.rejects(), self.rules).select(*self.spec.contract.schema.names)
        name = f"rejects of epoch {state.epoch} to batch {state.last_batch} by rules {self.rule_version}"
        again = Flow(self.spark, replace(self.spec, source=lambda _: accepted, rejects=None))
        return again.run(accept_volume=accept_volume, delivery=name, mode=runs.REPLAY)

    @property
    def rule_version(self) -> str:
        """A short digest of the validity rules: other rules, another version."""
        stated = "\n".join(f"{rule.name}: {rule.predicate}" for rule in self.rules)
        return hashlib.sha256(stated.encode()).hexdigest()[:12]

    def _rejects_folder(self) -> str:
        if not self.spec.rejects:
            raise ValueError("this flow stores no rejects")
        return self.spec.rejects

    def compact(self) -> bool:
        """Merge the folders of all confirmed batches into one; False if there is nothing to do.

        Every version is kept, so nothing that is published changes.  Readers stay with
        the old folders until the ledger row is in.  A run that broke off while publishing
        has to be followed by another run first.
        """
        spec, contract = self.spec, self.spec.contract
        state = runs.ledger_state(self.ledger())
        if state.last_batch < 2 or state.open_epoch is not None:
            return False
        begun, epoch = time.perf_counter(), state.epoch + 1
        rows = self._batches(state.epoch, state.last_batch).drop(publish.BATCH)
        self._retire(epoch)  # what a failed refresh left
        publish.write_batch(rows, spec.clean, epoch, state.last_batch, contract)
        merged = publish.read_batch(self.spark, spec.clean, epoch, state.last_batch, contract)
        sides = self._write_sides(merged, state, epoch, state.last_batch, first=True)
        at = datetime.now(timezone.utc).replace(microsecond=0).isoformat()
        done = runs.RunRecord(
            epoch=epoch, run_seq=state.last_run + 1, batch_id=state.last_batch, status=runs.COMPACTED,
            mode=runs.INCREMENTAL, started_at=at, duration_seconds=round(time.perf_counter() - begun, 3),
            rows_read=0, rows_rejected=0, rows_in_batch=0, dimension=state.dimension,
            watermark_before=state.cursor, watermark_after=state.cursor, sides=[s.name for s in sides],
        )
        runs.append_run(self.spark, spec.ledger, done)
        self._retire(state.epoch)
        return True

    # -- steps -------------------------------------------------------------

    def _scratch(self, name: str) -> str:
        """A table of the running batch, beside the mart; each run writes over the last one's."""
        return f"{self.spec.mart.rstrip('/')}.scratch/{name}"

    def _batches(self, epoch: int, last: int) -> DataFrame:
        return publish.read_batches(self.spark, self.spec.clean, epoch, last, self.spec.contract)

    def _mart_schema(self) -> StructType:
        empty = self.spark.createDataFrame([], self.spec.contract.clean_schema)
        mart = self.spec.mart_spec
        dimension = self.spec.dimension(self.spark) if mart.lookup else None
        return build_mart(empty, mart, self.spec.contract.key, dimension).schema

    def _key_days(self, what: str, columns: tuple[str, ...]):
        spec, contract = self.spec, self.spec.contract
        return key_days(
            self.spark, spec.clean, what, contract.clean_schema, columns, contract.day, spec.key_buckets
        )

    # -- the dimension -------------------------------------------------------

    def _stored_dimension(self, number: int | None) -> DataFrame | None:
        """A stored state of the dimension, one row per key; the dimension as it is for none."""
        brought = self.spec.mart_spec.lookup
        if not brought:
            return None
        given = self.spec.dimension(self.spark)
        unique = one_row_per_key(given, brought.dim_key, brought.columns)
        if number is None:
            return written(unique, self._scratch("dimension"))
        return self.spark.read.schema(unique.schema).parquet(self._dimension_folder(number))

    def _dimension_folder(self, number: int) -> str:
        return f"{self.spec.mart.rstrip('/')}.dimension/{number}"

    def _store_dimension(self, state: runs.LedgerState) -> int | None:
        """Store the dimension as it is now, in a folder that no ledger row relies on."""
        brought = self.spec.mart_spec.lookup
        if not brought:
            return None
        used = (state.dimension, state.open_dimension)
        number = next(n for n in range(DIMENSIONS) if n not in used)
        unique = one_row_per_key(self.spec.dimension(self.spark), brought.dim_key, brought.columns)
        written(unique, self._dimension_folder(number))
        return number

    def _changed_keys(self, before: int | None, after: int | None) -> DataFrame | None:
        """Keys of the dimension that differ between two stored states; None if one is unknown."""
        brought = self.spec.mart_spec.lookup
        if not brought or before is None or after is None:
            return None
        states = [self._stored_dimension(number) for number in (before, after)]
        changes = dimension_changes(*states, brought.dim_key, brought.columns)
        return written(changes, self._scratch("changed"))

    def _days_shown(
        self, changed: DataFrame | None, state: runs.LedgerState, last: int
    ) -> DataFrame | None:
        """Days up to batch ``last`` whose looked-up columns may differ; None without a lookup.

        Where no stored state is known, as for a mart from before they were kept, all days.
        """
        contract, brought = self.spec.contract, self.spec.mart_spec.lookup
        if not brought:
            return None
        facts = self._batches(state.epoch, last)
        if changed is None:
            days = touched_days(facts, contract.day)
        elif self.looked_up and self.looked_up.name in state.sides:
            kind = contract.clean_schema[brought.fact_key].dataType  # buckets depend on the type
            own = changed.select(F.col(brought.dim_key).cast(kind).alias(brought.fact_key))
            days = days_in(self.looked_up, own, contract.day, state.epoch, last)
        else:
            days = days_of_keys(facts, brought.fact_key, changed, brought.dim_key, contract.day)
        return written(days.coalesce(1), self._scratch("dated"))

    def _mart_of(self, rows: DataFrame, shown: int | None) -> DataFrame:
        """The mart of current rows, written to scratch, with the dimension as it was stored."""
        spec = self.spec
        dimension = self._stored_dimension(shown)
        mart = build_mart(rows, spec.mart_spec, spec.contract.key, dimension, reduced=True)
        return written(mart, self._scratch("mart"))

    # -- loads in slices -------------------------------------------------------

    def _load_slices(
        self,
        state: runs.LedgerState,
        record: Callable[..., runs.RunRecord],
        accept_volume: bool,
        most: int | None,
    ) -> tuple[list[runs.Slice], runs.RunRecord | None]:
        """Write and check what is left of a load, slice by slice.

        Returns all its slices, and the ledger's row of the last one if ``most`` ended the run.
        """
        spec, contract, epoch = self.spec, self.spec.contract, state.epoch + 1
        slices, row = list(state.slices), None
        if not slices:
            self._retire(epoch)  # what a load that began anew left
        source = parse_time(spec.source(self.spark), contract)
        before = slices[-1].watermark_after if slices else None
        held = sum(s.rows_read - s.rows_unreadable for s in slices)
        ends = self._slice_ends(rows_after(source, before, contract.time), held)
        for upto in ends[:most]:
            seen = new = rows_after(source, before, contract.time, upto=upto)
            if before is None:  # rows without a time, which no bound places, are of the first slice
                time = F.col(contract.time)
                new = source.filter((time <= time_literal(time_type(source, contract.time), upto)) | time.isNull())
            counts = self._profile(new, None, placed=False)
            counts.pop("high")
            batch = len(slices) + 1
            measured = self._write_batch(seen, epoch, batch)
            if spec.rejects:
                self._write_rejects(new, upto, epoch, batch)
            staged = publish.read_batch(self.spark, spec.clean, epoch, batch, contract)
            size, results = self._audit(staged, measured, accept_volume, ())
            try:
                gate(results)
            except BatchRejected:
                if state.open_epoch is not None:
                    self._restore(state)
                raise
            done = dict(batch_id=batch, watermark_after=upto, rows_in_batch=size, rules=self.rule_version, **counts)
            row = record(runs.STAGED, epoch=epoch, checks=results, **done)
            slices.append(runs.Slice(**done))
            before = upto
        return slices, row if most is not None and len(ends) > most else None

    def _slice_ends(self, rows: DataFrame, held: int) -> list[str]:
        """The newest time of each slice of ``rows``, which ``held`` rows of the load precede.

        The rows before a day say which slice it is of, so a load that is taken up again
        is cut where it would have been.
        """
        time, kind = self.spec.contract.time, time_type(rows, self.spec.contract.time)
        times = rows.select(F.col(time).alias("time")).filter("time IS NOT NULL")
        days = times.groupBy(F.to_date("time").alias("day")).agg(
            F.count(F.lit(1)).alias("n"), F.max("time").alias("newest")
        )
        earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # one row a calendar day
        number = F.floor((F.coalesce(F.sum("n").over(earlier), F.lit(0)) + held) / self.spec.slice_rows)
        ends = days.select(number.alias("slice"), "newest").groupBy("slice").agg(
            time_text(kind, F.max("newest")).alias("upto")
        )
        return [r["upto"] for r in ends.orderBy("slice").collect()]

    def _publish_slices(
        self,
        state: runs.LedgerState,
        slices: list[runs.Slice],
        shown: int | None,
        record: Callable[..., runs.RunRecord],
    ) -> runs.RunRecord:
        """Make the slices of a finished load count, as one batch would, and the mart what they say."""
        contract, epoch, batch = self.spec.contract, state.epoch + 1, slices[-1].batch_id
        versions = self._batches(epoch, batch).drop(publish.BATCH)
        for table in self._sides():
            table.retire(epoch)  # what an attempt that broke off here left
        sides = self._write_sides(versions, state, epoch, batch, first=True)
        counts = ("rows_read", "rows_rejected", "rows_unreadable", "rows_in_batch")
        facts = dict(
            epoch=epoch, batch_id=batch, watermark_after=slices[-1].watermark_after, dimension=shown,
            sides=[table.name for table in sides], **{c: sum(getattr(s, c) for s in slices) for c in counts},
        )
        record(runs.PUBLISHING, **facts)
        self._replace(latest_per_key(versions, contract.key, contract.time, contract.ties), None, shown)
        checks = [
            CheckResult(r["name"], r["passed"], f"in {r['slices']} slices")
            for r in runs.slice_checks(self.ledger(), epoch, state.last_run + 1).collect()
        ]
        done = record(runs.SUCCESS, checks=checks, **facts)
        if state.epoch:
            self._retire(state.epoch)
        return done

    # -- side tables -----------------------------------------------------------

    def _sides(self) -> list:
        return [table for table in (self.keys, self.looked_up, self.state) if table]

    def _write_sides(
        self, staged: DataFrame, state: runs.LedgerState, epoch: int, batch: int, first: bool, keyed: bool = False
    ) -> list:
        """Add a batch to the side tables that hold all batches before it, and return these.

        ``keyed`` states that ``staged`` has one row per key, as one batch has.
        """
        contract = self.spec.contract
        held = [table for table in self._sides() if first or table.name in state.sides]
        if self.state in held:
            fresh = staged
            if first:
                superseded = staged.limit(0)
                if not keyed:
                    fresh = latest_per_key(staged, contract.key, contract.time, contract.ties)
            else:
                superseded = self._superseded(staged, state)
            self.state.add(fresh, superseded, epoch, batch)
        for table in held:
            if table is not self.state:
                pairs = staged.select(*table.schema.names)
                if not (keyed and table is self.keys):
                    pairs = pairs.distinct()
                table.add(pairs, epoch, batch)
        return held

    def _superseded(self, staged: DataFrame, state: runs.LedgerState) -> DataFrame:
        """The current version of each of the batch's keys before the batch, where there was one."""
        contract = self.spec.contract
        keys = written(staged.select(*contract.key), self._scratch("keys"))
        known = self._batches(state.epoch, state.last_batch).drop(publish.BATCH)
        if not self._on_all_days(keys, known, state):
            days = days_in(self.keys, keys, contract.day, state.epoch, state.last_batch)
            days = [row[0] for row in days.collect()]  # one a calendar day
            known = known.filter(F.col(contract.day).isin(days))
        known = known.join(keys, [*contract.key], "left_semi")
        return latest_per_key(known, contract.key, contract.time, contract.ties).select(*staged.columns)

    def _on_all_days(self, keys: DataFrame, known: DataFrame, state: runs.LedgerState) -> bool:
        """Whether the keys of one bucket alone prove that a wide batch's have versions on all days.

        There the index has nothing to leave out.
        """
        day = self.spec.contract.day
        if keys.count() <= FEW_KEYS:
            return False
        some = keys.filter(self.keys.bucket_of(self.keys.columns) == 0)
        found = days_in(self.keys, some, day, state.epoch, state.last_batch).collect()  # one a calendar day
        there = touched_days(known, day).collect()
        return {row[0] for row in there} <= {row[0] for row in found}

    def _replace_from_state(self, epoch: int, batch: int) -> None:
        """Replace the days that the state says a batch has changed."""
        spec, contract = self.spec, self.spec.contract
        days = written(self.state.days(epoch, batch, contract.day), self._scratch("days"))
        values = [row[0] for row in days.collect()]  # one a calendar day
        if values:
            mart = written(self.state.mart(days, epoch, batch), self._scratch("mart"))
            publish.replace_days(mart, values, spec.mart, contract.day, spec.mart_spec.grain)

    def _retire(self, epoch: int) -> None:
        publish.retire_epoch(self.spark, self.spec.clean, epoch, self.spec.contract)
        for table in self._sides():
            table.retire(epoch)

    def _new_rows(self, state: runs.LedgerState, cursor: str | None, bounded: bool) -> DataFrame:
        """Rows that no confirmed batch has dealt with, and those whose time is unreadable.

        Rows up to the cursor, which a lookback or new files bring, count if they beat the
        known versions of their key.  An invalid row of a lookback has been counted when
        it was new, and is not counted again.
        """
        spec, contract = self.spec, self.spec.contract
        rows = parse_time(spec.source(self.spark), contract)
        if cursor is None:
            return rows
        if bounded:
            rows = rows_after(rows, cursor, contract.time, spec.lookback, unreadable=True)
            if not spec.lookback:
                return rows
            late = F.col(contract.time) <= time_literal(time_type(rows, contract.time), cursor)
            rows = rows.filter(~(F.coalesce(late, F.lit(False)) & is_rejected(self.rules)))
        known = self._batches(state.epoch, state.last_batch)
        return not_known(rows, known, contract.key, contract.time, contract.ties, cursor)

    def _profile(self, new: DataFrame, cursor: str | None, placed: bool) -> dict:
        """Counts, and the next cursor.

        With ``placed``, rows without a time come from all of the source and not from what
        is new, so they are counted apart only.
        """
        contract = self.spec.contract
        unreadable = F.col(contract.time).isNull()
        counted = ~unreadable if placed else F.lit(True)
        return new.agg(
            F.count_if(counted).alias("rows_read"),
            F.count_if(counted & is_rejected(self.rules)).alias("rows_rejected"),
            F.count_if(unreadable).alias("rows_unreadable"),
            high_mark(new, contract.time, cursor).alias("high"),
        ).first().asDict()

    def _write_batch(self, batch_rows: DataFrame, epoch: int, batch: int) -> dict[str, int]:
        """Write a batch; returns what its checks count row by row, counted on the way."""
        contract = self.spec.contract
        valid = valid_rows(batch_rows, self.rules).select(*contract.clean_schema.names)
        clean = latest_per_key(valid, contract.key, contract.time, contract.ties)
        return publish.write_batch(
            clean, self.spec.clean, epoch, batch, contract, scan_counts(self.spec.checks)
        )

    def _write_rejects(self, new: DataFrame, high: str | None, epoch: int, batch: int) -> None:
        contract = self.spec.contract
        upto = F.col(contract.time) <= time_literal(time_type(new, contract.time), high)
        (
            rejected_rows(new.filter(F.coalesce(upto, F.lit(True))), self.rules)
            .withColumn(publish.RULE_VERSION, F.lit(self.rule_version))
            .write.mode("overwrite")
            .parquet(f"{self.spec.rejects}/{publish.EPOCH}={epoch}/{publish.BATCH}={batch}")
        )

    def _audit(
        self, staged: DataFrame, measured: dict[str, int], accept_volume: bool, volumes: tuple[int, ...]
    ) -> tuple[int, list[CheckResult]]:
        plan = self.spec.checks
        recent = volumes[-plan.history_lookback :] if plan.history_lookback else volumes
        earlier = (len(recent), median(recent) if recent else None)
        dimension = self.spec.dimension(self.spark) if plan.reference else None
        row = audit(staged, plan, earlier, dimension, measured).first()
        results = [CheckResult(**c.asDict()) for c in row["checks"]]
        if accept_volume:
            results = [
                CheckResult(c.name, True, f"accepted: {c.detail}")
                if c.name == "volume_anomaly" and not c.passed else c
                for c in results
            ]
        return row["rows"], results

    def _replace_affected(
        self,
        staged: DataFrame,
        state: runs.LedgerState,
        last: int,
        shown: int | None,
        changed: DataFrame | None,
    ) -> None:
        """Replace the days that a batch or a changed dimension affects by what batches up to ``last`` say."""
        contract = self.spec.contract
        if self.keys and self.keys.name in state.sides:
            moved = days_in(
                self.keys, staged.select(*contract.key), contract.day, state.epoch, state.last_batch
            )
            days = touched_days(staged, contract.day).union(moved)
        else:
            history = self._batches(state.epoch, state.last_batch)
            known = days_of_some_keys(staged, history, contract)
            others = history.filter(~F.col(contract.day).isin(known))
            days = self._as_days(known).union(affected_days(staged, others, contract))
        dated = self._days_shown(changed, state, last)
        if dated is not None:
            days = days.union(dated)
        days = written(days.distinct().coalesce(1), self._scratch("days"))
        self._replace_days(days, self._batches(state.epoch, last), shown)

    def _replace_days(self, days: DataFrame, versions: DataFrame, shown: int | None) -> None:
        contract = self.spec.contract
        values = [row[0] for row in days.select(contract.day).collect()]  # one a calendar day
        if values:  # else no valid row in the batch
            recent = versions.filter(F.col(contract.day) >= F.lit(min(values)))
            there = {row[0] for row in touched_days(recent, contract.day).collect()}  # one a calendar day
            rows = current_rows(
                versions.drop(publish.BATCH), days, min(values), contract, complete=there <= set(values)
            )
            self._replace(rows, values, shown)

    def _as_days(self, values: list) -> DataFrame:
        day = self.spec.contract.day
        return self.spark.createDataFrame([(v,) for v in values], StructType([self.spec.contract.clean_schema[day]]))

    def _replace(self, rows: DataFrame, days: list | None, shown: int | None) -> None:
        spec = self.spec
        publish.replace_days(
            self._mart_of(rows, shown), days, spec.mart, spec.contract.day, spec.mart_spec.grain
        )

    def _restore(self, state: runs.LedgerState) -> None:
        """Make the mart what the ledger confirms, batches and dimension, after a run broke off in it."""
        contract = self.spec.contract
        if state.open_epoch == state.epoch:
            staged = publish.read_batch(
                self.spark, self.spec.clean, state.open_epoch, state.open_batch, contract
            )
            changed = self._changed_keys(state.dimension, state.open_dimension)
            self._replace_affected(staged, state, state.last_batch, state.dimension, changed)
        else:
            rows = self._batches(state.epoch, state.last_batch).drop(publish.BATCH)
            newest = latest_per_key(rows, contract.key, contract.time, contract.ties)
            self._replace(newest, None, state.dimension)


def _finite_amounts(contract: Contract, mart: MartSpec) -> list[Rule]:
    """A rule for each money column that the contract has none for."""
    stated = {rule.name for rule in contract.validity}
    columns = dict.fromkeys(m.column for m in mart.measures if isinstance(m, Money))
    kinds = {f.name: f.dataType for f in contract.schema}
    return [
        FiniteRule(f"{c}_finite", "", value=mart.derived.get(c, lambda c=c: F.col(c)))
        for c in columns
        if f"{c}_finite" not in stated and not isinstance(kinds.get(c), (IntegralType, DecimalType))
    ]
