"""Rebuilding affected days, against deduplicating everything by brute force."""

import datetime as dt
import random

import pytest

from martflow.operators import DAILY_CATEGORY_MART, CheckPlan, affected_days, current_rows, days_of_some_keys
from martflow.plans import Flow, FlowSpec, written
from workloads.tables import EVENT_ORDERS

SCHEMA = EVENT_ORDERS.clean_schema
START = dt.datetime(2025, 2, 1)


def versions(seed, n=120, keys=25, days=12):
    """Rows in time order; keys come back with later versions, on the same or other days."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        at = START + dt.timedelta(seconds=rnd.randrange(days * 86_400))
        rows.append((
            rnd.randrange(keys) if rnd.random() < 0.7 else 7, rnd.randrange(6), at,
            rnd.choice(["a", "b", None]), rnd.randrange(0, 4), float(rnd.randrange(1, 900)) / 100, at.date(),
        ))
    return sorted(rows, key=lambda r: r[2])


def newest(rows):
    """Latest valid row per key, ties by the remaining columns."""
    best = {}
    for r in rows:
        if r[4] > 0:
            rank = (r[2], r[1], r[3] is not None, r[3] or "", r[4], r[5])
            if r[0] not in best or rank > best[r[0]][0]:
                best[r[0]] = (rank, r)
    return [r for _, r in best.values()]


def mart(rows):
    groups = {}
    for r in newest(rows):
        groups.setdefault((r[6], r[3]), []).append(r)
    result = {}
    for key, members in groups.items():
        cents = sum(round(r[4] * r[5] * 100) for r in members)
        n = len(members)
        result[key] = (
            cents / 100, n, len({r[1] for r in members}), sum(r[4] for r in members),
            (2 * cents + n) // (2 * n) / 100,
        )
    return result


@pytest.mark.parametrize("seed", range(4))
def test_current_rows_of_some_days(spark, tmp_path, seed):
    rows = [r for r in versions(seed) if r[4] > 0]
    history = spark.createDataFrame(rows, SCHEMA).repartition(5)
    rnd = random.Random(seed)
    chosen = rnd.sample(sorted({r[6] for r in rows}), 3)
    days = written(spark.createDataFrame([(d,) for d in chosen], "order_date date"), str(tmp_path / "days"))
    got = current_rows(history, days, min(chosen), EVENT_ORDERS)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(r) for r in newest(rows) if r[6] in chosen)


@pytest.mark.parametrize("seed", range(3))
def test_affected_days(spark, seed):
    rows = versions(seed)
    cut = len(rows) * 3 // 4
    history, batch = rows[:cut], rows[cut:]
    keys = {r[0] for r in batch}
    expected = {r[6] for r in batch} | {r[6] for r in history if r[0] in keys}
    frames = (spark.createDataFrame(part, SCHEMA) for part in (batch, history))
    assert {r[0] for r in affected_days(*frames, EVENT_ORDERS).collect()} == expected


@pytest.mark.parametrize("apart", (1, 3, 256))
def test_days_of_some_keys_are_affected_days(spark, monkeypatch, apart):
    monkeypatch.setattr("martflow.operators.days.KEYS_APART", apart)
    rows = versions(5)
    history, batch = (spark.createDataFrame(part, SCHEMA) for part in (rows[:90], rows[90:]))
    every = {r[0] for r in affected_days(batch, history, EVENT_ORDERS).collect()}
    some = set(days_of_some_keys(batch, history, EVENT_ORDERS))
    assert {r[6] for r in rows[90:]} <= some <= every
    assert apart > 1 or some == every


def test_a_rebuild_of_all_days_looks_nowhere_else(spark, tmp_path):
    rows = [r for r in versions(6) if r[4] > 0]
    history = spark.createDataFrame(rows, SCHEMA)
    listed = sorted({r[6] for r in rows})[2:]
    days = written(spark.createDataFrame([(d,) for d in listed], "order_date date"), str(tmp_path / "days"))
    plans = []
    for complete in (False, True):
        got = current_rows(history, days, listed[0], EVENT_ORDERS, complete)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(r) for r in newest(rows) if r[6] in listed)
        plans.append(got._jdf.queryExecution().optimizedPlan().toString())
    assert "Join" in plans[0] and "Join" not in plans[1]


@pytest.mark.parametrize("seed", range(4))
def test_any_batches_give_the_mart_of_one_full_run(spark, tmp_path, seed):
    rows = versions(seed)
    raw = written(spark.createDataFrame([r[:6] for r in rows], EVENT_ORDERS.schema), str(tmp_path / "raw"))
    cuts = sorted(random.Random(seed).sample([r[2] for r in rows], 3))
    for cut in (*cuts, dt.datetime(9999, 1, 1)):
        flow = Flow(spark, FlowSpec(
            source=lambda s, cut=cut: raw.filter(raw.order_ts <= cut),
            clean=str(tmp_path / "clean"), mart=str(tmp_path / "mart"), ledger=str(tmp_path / "ledger"),
            contract=EVENT_ORDERS, mart_spec=DAILY_CATEGORY_MART,
            checks=CheckPlan(unique=("order_id",), min_history=99),
        ))
        flow.run()
        published = {(r[0], r[1]): tuple(r)[2:] for r in flow.mart().collect()}
        assert published == mart([r for r in rows if r[2] <= cut])
    flow.run(full_refresh=True)
    assert {(r[0], r[1]): tuple(r)[2:] for r in flow.mart().collect()} == mart(rows)
