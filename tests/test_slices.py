"""First loads and refreshes that go in slices."""

import dataclasses

import plain
import pytest
from test_flow import MOVED, ORPHAN, STEPS, WEEK1, WEEK2, WEEK3, Crash, Shop

from martflow.operators import BatchRejected
from martflow.plans import Flow, ledger
from martflow.plans import flow as flow_module
from martflow.plans import publish
from martflow.sources import Rule

ALL = WEEK1 + WEEK2 + MOVED + WEEK3  # rows of five days: 2, 2, 2, 1 and 1
SLICES = [("2024-11-05 21:59:59", 4), ("2024-11-12 06:31:44", 2), ("2024-11-19 12:00:00", 2)]
BAD = (
    "g701,k-ben,some day,tools,4,12.75\n"  # has no time
    "g702,k-ben,2024-11-05 10:00:00,tools,-4,12.75\n"
    "g703,k-ben,2024-11-13 09:00:00,,2,nan\n"
)


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path, slice_rows=3)


def staged(shop):
    rows = shop.flow.ledger().filter("status = 'staged'").orderBy("run_seq", "batch_id").collect()
    return [(r["watermark_after"], r["rows_in_batch"]) for r in rows]


def batches(shop, epoch=1):
    root = shop.folder / f"out/clean/orders/epoch={epoch}"
    return {f: f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


def break_off_at(shop, monkeypatch, module, name, times, rows, **options):
    """Run until ``name`` is called for the ``times``-th time, which fails."""
    real, calls = getattr(module, name), []

    def counted(*args, **kwargs):
        calls.append(name)
        if len(calls) == times:
            raise Crash
        return real(*args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(module, name, counted)
        with pytest.raises(Crash):
            shop.run(rows, **options)


def test_slices_are_whole_days_and_count_as_one_load(shop):
    done = shop.run(ALL)
    assert staged(shop) == SLICES
    assert (done.status, done.batch_id, done.rows_read, done.rows_in_batch) == ("success", 3, 8, 8)
    assert [c.passed for c in done.checks] == [True] * 5 and done.checks[0].detail == "in 3 slices"
    assert (shop.mart(), shop.cursor(), shop.volumes()) == (plain.mart(ALL), SLICES[-1][0], [8])
    assert shop.last()["status"] == "success"
    assert shop.run(ALL).status == "no_new_data"
    later = "g801,k-ana,2024-11-21 08:00:00,pots,1,3.00\ng501,k-ana,2024-11-22 08:00:00,tools,1,1.00\n"
    assert (shop.run(ALL + later).batch_id, shop.mart()) == (4, plain.mart(ALL + later))


@pytest.mark.parametrize("size", [1, 2, 5, 8, 100])
def test_any_size_gives_the_same_mart(spark, tmp_path, size):
    shop = Shop(spark, tmp_path, slice_rows=size)
    shop.run(ALL + BAD)
    assert shop.mart() == plain.mart(ALL)
    assert len(staged(shop)) == {1: 5, 2: 5, 5: 2, 8: 2, 100: 1}[size]
    row = shop.last()
    assert (row["rows_read"], row["rows_rejected"], row["rows_unreadable"]) == (11, 3, 1)


@pytest.mark.parametrize("refresh", [False, True])
@pytest.mark.parametrize("call", [(publish, "write_batch"), (flow_module, "audit"), (ledger, "append_run")])
def test_a_load_that_breaks_off_in_its_second_slice_reads_only_what_is_left(shop, monkeypatch, call, refresh):
    epoch = 1
    if refresh:
        shop.run(WEEK1)
        epoch = 2
    break_off_at(shop, monkeypatch, *call, 2, ALL, full_refresh=refresh)
    assert shop.mart() == (plain.mart(WEEK1) if refresh else {})
    first = {f: t for f, t in batches(shop, epoch).items() if "batch_id=1/" in str(f)}
    shop.run(ALL, full_refresh=refresh)
    assert first.items() <= batches(shop, epoch).items()
    assert staged(shop)[-3:] == SLICES and len(staged(shop)) == 3 + refresh
    assert (shop.mart(), shop.volumes(), shop.flow.clean().count()) == (plain.mart(ALL), [8], 8)


@pytest.mark.parametrize("refresh", [False, True])
@pytest.mark.parametrize("step", ["before the mart is replaced", "before the last ledger row"])
def test_a_load_that_breaks_off_while_it_publishes_is_finished_by_the_next_run(shop, monkeypatch, step, refresh):
    if refresh:
        shop.run(WEEK1)
    if step == "before the mart is replaced":
        break_off_at(shop, monkeypatch, *STEPS[step][:2], 1, ALL, full_refresh=refresh)
    else:  # after three slices and the announcement
        break_off_at(shop, monkeypatch, *STEPS[step][:2], 5, ALL, full_refresh=refresh)
    before = batches(shop, 1 + refresh)
    done = shop.run(ALL)
    assert done.status == "success" and done.mode == ("full_refresh" if refresh else "incremental")
    assert batches(shop, 1 + refresh) == before
    assert (shop.mart(), shop.volumes()) == (plain.mart(ALL), [8])
    assert not refresh or not batches(shop, 1)


def test_a_run_may_end_after_some_slices(shop):
    assert [shop.run(ALL, most_slices=1).status for _ in range(3)] == ["staged", "staged", "success"]
    assert (staged(shop), shop.mart()) == (SLICES, plain.mart(ALL))
    with pytest.raises(ValueError, match="most_slices"):
        shop.run(ALL, most_slices=0)


def test_readers_see_nothing_of_a_load_before_its_end(shop):
    shop.run(WEEK1)
    shop.run(ALL, full_refresh=True, most_slices=2)
    assert (shop.mart(), shop.flow.clean().count(), shop.volumes()) == (plain.mart(WEEK1), 4, [4])
    assert (shop.cursor(), shop.last()["mode"]) == (SLICES[0][0], "incremental")


def test_rows_that_come_while_a_load_rests_are_taken_up(shop):
    shop.run(WEEK1 + WEEK2, most_slices=1)
    shop.run(ALL)
    assert (shop.mart(), shop.volumes()) == (plain.mart(ALL), [8])


def test_another_run_in_between_makes_a_refresh_begin_anew(shop):
    shop.run(WEEK1)
    shop.run(WEEK1 + WEEK2, full_refresh=True, most_slices=1)
    shop.run(WEEK1 + WEEK2)
    assert shop.mart() == plain.mart(WEEK1 + WEEK2)
    done = shop.run(ALL, full_refresh=True)
    assert (done.rows_in_batch, shop.mart(), shop.flow.clean().count()) == (8, plain.mart(ALL), 8)


@pytest.mark.parametrize("why", ["resume", "rules", "no slices"])
def test_a_load_can_begin_anew(shop, spark, why):
    shop.run(ALL, most_slices=2)
    options = {"resume": False} if why == "resume" else {}
    if why == "rules":
        contract = dataclasses.replace(shop.spec.contract, rules=(*shop.spec.contract.rules, Rule("few", "quantity < 5")))
        shop.flow = Flow(spark, dataclasses.replace(shop.spec, contract=contract))
    if why == "no slices":
        shop.flow = Flow(spark, dataclasses.replace(shop.spec, slice_rows=None))
    done = shop.run(WEEK2 + WEEK3, **options)
    assert shop.flow.ledger().filter("status = 'discarded'").count() == 1
    kept = WEEK2 if why == "rules" else WEEK2 + WEEK3
    assert (done.status, shop.mart()) == ("success", plain.mart(kept))
    assert shop.flow.clean().count() == len(kept.splitlines())
    shop.run(ALL, **options)
    assert shop.flow.ledger().filter("status = 'discarded'").count() == 1


def test_a_slice_that_fails_its_checks_stops_the_load_there(shop):
    shop.run(WEEK1)
    with pytest.raises(BatchRejected):
        shop.run(WEEK1 + WEEK2 + WEEK3 + ORPHAN, full_refresh=True)
    assert (shop.mart(), len(staged(shop))) == (plain.mart(WEEK1), 3)
    shop.run(WEEK1 + WEEK2 + WEEK3, full_refresh=True)
    assert shop.mart() == plain.mart(WEEK1 + WEEK2 + WEEK3)


@pytest.mark.parametrize("differences", [False, True])
def test_side_tables_hold_every_slice(spark, tmp_path, monkeypatch, differences):
    shop = Shop(spark, tmp_path, slice_rows=3, key_buckets=4, differences=differences)
    break_off_at(shop, monkeypatch, publish, "replace_days", 1, WEEK1 + WEEK2)
    shop.run(ALL)
    assert shop.mart() == plain.mart(ALL)
    later = "g501,k-ana,2024-11-22 08:00:00,tools,1,1.00\ng503,k-ana,2024-11-22 09:00:00,pots,1,2.00\n"
    shop.run(ALL + later)
    assert shop.mart() == plain.mart(ALL + later)


def test_rejects_of_slices_can_be_replayed(spark, tmp_path):
    shop = Shop(spark, tmp_path, slice_rows=3, rejects=str(tmp_path / "rejects"))
    strict = dataclasses.replace(shop.spec.contract, rules=(*shop.spec.contract.rules, Rule("few", "quantity < 5")))
    shop.flow = Flow(spark, dataclasses.replace(shop.spec, contract=strict))
    shop.run(ALL + BAD)
    kept = sorted((r["order_id"], r["batch_id"]) for r in shop.flow.rejects().collect())
    assert kept == [("g503", 1), ("g503", 3), ("g507", 4), ("g701", 1), ("g702", 1), ("g703", 3)]
    shop.flow = Flow(spark, shop.spec)
    shop.flow.replay()
    assert shop.mart() == plain.mart(ALL)


def test_sources_without_a_time_or_a_row(shop):
    assert shop.run("").status == "no_new_data"
    assert shop.run(BAD.splitlines(keepends=True)[0]).status == "no_new_data"
    shop.run(ALL)
    assert shop.run("", full_refresh=True).rows_in_batch == 0
    assert shop.mart() == {}
    with pytest.raises(ValueError, match="slice_rows"):
        Flow(shop.flow.spark, dataclasses.replace(shop.spec, slice_rows=0))
