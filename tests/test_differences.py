"""The key index, and marts kept up to date by what batches add and supersede."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_flow import STEPS, Crash
from test_rebuild import mart, versions

from martflow.operators import DAILY_CATEGORY_MART, CheckPlan, CountDistinct, MartSpec, Money, Sum, deltas
from martflow.operators.deltas import REFERENCES, VALUE, counted_moves
from martflow.plans import Flow, FlowSpec, written
from martflow.plans import flow as flows
from martflow.plans.sides import SideTable, days_in, key_days
from workloads.tables import EVENT_ORDERS

SCHEMA = EVENT_ORDERS.clean_schema


def flow_over(spark, folder, raw, cut, **changes):
    options = dict(key_buckets=4, differences=True, checks=CheckPlan(min_history=99), mart_spec=DAILY_CATEGORY_MART)
    return Flow(spark, FlowSpec(
        source=lambda s: raw.filter(raw.order_ts <= cut), clean=f"{folder}/clean", mart=f"{folder}/mart",
        ledger=f"{folder}/ledger", contract=EVENT_ORDERS, **{**options, **changes},
    ))


def published(flow):
    return {(r[0], r[1]): tuple(r)[2:] for r in flow.mart().collect()}


def cuts_of(rows, seed, count=3):
    return [*sorted(random.Random(seed).sample([r[2] for r in rows], count)), dt.datetime(9999, 1, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_differences_give_the_mart_of_one_full_run(spark, tmp_path, seed):
    rows = versions(seed)
    raw = written(spark.createDataFrame([r[:6] for r in rows], EVENT_ORDERS.schema), str(tmp_path / "raw"))
    for turn, cut in enumerate(cuts_of(rows, seed)):
        flow = flow_over(spark, tmp_path, raw, cut)
        flow.run()
        assert published(flow) == mart([r for r in rows if r[2] <= cut])
        if turn == 1:
            assert flow.compact()
    assert flow.ledger().filter("status = 'success' AND size(sides) <> 2").count() == 0
    flow.run(full_refresh=True)
    assert published(flow) == mart(rows)


@pytest.mark.parametrize("seed", range(2))
def test_wide_batches_give_the_same(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(deltas, "FEW_MOVES", 0)
    monkeypatch.setattr(flows, "FEW_KEYS", 0)
    rows = versions(seed)
    raw = written(spark.createDataFrame([r[:6] for r in rows], EVENT_ORDERS.schema), str(tmp_path / "raw"))
    for cut in cuts_of(rows, seed):
        flow = flow_over(spark, tmp_path, raw, cut)
        flow.run()
        assert published(flow) == mart([r for r in rows if r[2] <= cut])


def test_keys_on_all_days_spare_the_index(spark, tmp_path, monkeypatch):
    """Half the keys come again: those of one bucket have versions on all ten days."""
    start, sought = dt.datetime(2024, 1, 1), []
    old = [(k, k % 7, start + dt.timedelta(days=k % 10), "a", 1, 2.0) for k in range(400)]
    new = [(k, k % 7, start + dt.timedelta(days=20), "a", 1, 3.0) for k in range(0, 400, 2)]
    new += [(k, k % 7, start + dt.timedelta(days=20), "a", 1, 3.0) for k in range(1, 400, 4)]
    raw = written(spark.createDataFrame(old + new, EVENT_ORDERS.schema), str(tmp_path / "raw"))
    monkeypatch.setattr(flows, "FEW_KEYS", 100)
    monkeypatch.setattr(flows, "days_in", lambda index, keys, *rest: sought.append(keys.count()) or days_in(index, keys, *rest))
    for cut in (start + dt.timedelta(days=15), start + dt.timedelta(days=30)):
        flow = flow_over(spark, tmp_path, raw, cut)
        flow.run()
    assert len(sought) == 1 and 0 < sought[0] < len(new) / 2
    latest = {r[0]: r for r in old} | {r[0]: r for r in new}
    assert sum(r["orders"] for r in flow.mart().collect()) == len(latest)


def test_many_moves_meet_the_earlier_rows_in_one_shuffle(spark, tmp_path, monkeypatch):
    spec = MartSpec("d", ("d", "g"), (CountDistinct("n", "v"),))
    kinds = f"d int, g string, {VALUE} long, {REFERENCES} long"
    moved = [(1, "a", 1, 1), (1, "a", 2, -1), (1, None, 3, -1), (2, "b", 4, 1), (2, "b", 5, -1)]
    held = [(1, "a", 1, 2), (1, "a", 2, 1), (1, None, 3, 1), (2, "b", 5, 3), (3, "c", 9, 1), (1, "a", 7, 1)]
    moves = written(spark.createDataFrame(moved, kinds), str(tmp_path / "moves"))
    known = written(spark.createDataFrame(held, kinds), str(tmp_path / "known"))
    wanted = {(1, "a"): -1, (1, None): -1, (2, "b"): 1}
    for few, joins in ((0, 0), (5, 1)):
        monkeypatch.setattr(deltas, "FEW_MOVES", few)
        found = counted_moves(moves, known, spec, spec.measures[0])
        assert {(r["d"], r["g"]): r["n"] for r in found.collect()} == wanted
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftSemi") == joins


@pytest.mark.parametrize("step", [*STEPS])
def test_a_run_that_breaks_off_leaves_no_difference(spark, tmp_path, monkeypatch, step):
    rows = versions(5, n=60)
    raw = written(spark.createDataFrame([r[:6] for r in rows], EVENT_ORDERS.schema), str(tmp_path / "raw"))
    first, second, last = cuts_of(rows, 5, 2)
    flow_over(spark, tmp_path, raw, first).run()
    with monkeypatch.context() as patched:
        patched.setattr(*STEPS[step])
        with pytest.raises(Crash):
            flow_over(spark, tmp_path, raw, last).run()
    flow = flow_over(spark, tmp_path, raw, second)  # the retry sees fewer rows than the run that broke off
    flow.run()
    assert published(flow) == mart([r for r in rows if r[2] <= second])
    flow = flow_over(spark, tmp_path, raw, last)
    flow.run()
    assert published(flow) == mart(rows)


def test_switched_on_later(spark, tmp_path):
    """Without an index of all batches a flow works as before, until batches are merged."""
    rows = versions(6, n=60)
    raw = written(spark.createDataFrame([r[:6] for r in rows], EVENT_ORDERS.schema), str(tmp_path / "raw"))
    first, second, third, last = cuts_of(rows, 6)
    flow_over(spark, tmp_path, raw, first, key_buckets=None, differences=False).run()
    for cut, sides in ((second, 0), (third, 0), (last, 2)):
        flow = flow_over(spark, tmp_path, raw, cut)
        done = flow.run()
        assert len(done.sides) == sides
        assert published(flow) == mart([r for r in rows if r[2] <= cut])
        if cut is third:
            assert flow.compact()


def test_sums_of_amounts_that_are_null_or_doubles(spark, tmp_path):
    spec = MartSpec(
        "order_date", ("order_date", "category"),
        (Sum("price", "unit_price"), Money("value", "odd"), CountDistinct("buyers", "customer_id")),
        derived={"odd": lambda: F.when(F.col("quantity") > 1, F.col("unit_price"))},
    )
    rows = versions(8, n=80)
    raw = written(spark.createDataFrame([r[:6] for r in rows], EVENT_ORDERS.schema), str(tmp_path / "raw"))
    for cut in cuts_of(rows, 8):
        flow = flow_over(spark, tmp_path, raw, cut, mart_spec=spec)
        flow.run()
    plain_flow = flow_over(spark, tmp_path / "once", raw, cut, mart_spec=spec, differences=False)
    plain_flow.run()
    got, once = published(flow), published(plain_flow)
    assert {k: (pytest.approx(v[0]), *v[1:]) for k, v in once.items()} == got
    assert any(v[1] is None for v in got.values())


def test_a_spec_that_differences_do_not_fit(spark, tmp_path):
    raw = spark.createDataFrame([], EVENT_ORDERS.schema)
    with pytest.raises(ValueError, match="index"):
        flow_over(spark, tmp_path, raw, dt.datetime(9999, 1, 1), key_buckets=None)


def test_a_correction_reads_its_buckets_only(spark, tmp_path):
    """Random text keys: what is read of the index follows the number of keys sought."""
    pairs = spark.range(40_000).select(
        F.sha1(F.col("id").cast("string")).alias("k"), (F.col("id") % 365).cast("int").alias("d"), F.lit(1).alias("key_bucket"),
    )
    index = key_days(spark, str(tmp_path / "clean"), "key_days", pairs.schema, ["k"], "d", 128)
    index.add(pairs.filter("d < 200"), 1, 1)
    index.add(pairs.filter("d >= 200"), 1, 2)
    index.add(pairs.withColumn("d", F.lit(999)), 1, 3)  # of a run that broke off
    for sought in (1, 8, 64):
        ids = random.Random(sought).sample(range(40_000), sought)
        names = [hashlib.sha1(str(i).encode()).hexdigest() for i in ids]
        keys = written(pairs.filter(F.col("k").isin(names)), str(tmp_path / f"keys{sought}"))
        assert {r[0] for r in days_in(index, keys, "d", 1, 2).collect()} == {i % 365 for i in ids}
        assert index.read(1, 2, keys).count() <= 1.5 * sought * 40_000 / 128
    assert index.read(1, 2).count() == 40_000
    assert days_in(index, keys.limit(0), "d", 1, 2).count() == 0
    index.retire(1)
    assert index.read(1, 3).count() == 0


def test_null_values_have_a_bucket(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "g string, n long")
    side = SideTable(spark, str(tmp_path / "side"), rows.schema, ["g"], 8)
    side.add(rows, 1, 1)
    assert [tuple(r) for r in side.read(1, 1, rows.filter("g IS NULL")).filter("g IS NULL").collect()] == [(None, 1)]
    with pytest.raises(ValueError):
        SideTable(spark, "x", rows.schema, ["g"], 0)
