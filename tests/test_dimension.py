"""Marts that look up a dimension which changes between runs."""

import dataclasses
import random

import plain
import pytest
from test_flow import STEPS, WEEK1, WEEK2, WEEK3, Crash

from martflow.operators import DAILY_CATEGORY_MART, BatchRejected, CheckPlan, Lookup, days_of_keys, dimension_changes
from martflow.plans import Flow, last_run, retail_spec, volume_history

COUNTRY_MART = dataclasses.replace(
    DAILY_CATEGORY_MART,
    grain=("order_date", "country"),
    lookup=Lookup("customer_id", "customer_id", ("country",)),
)


class Shop:
    """Source files, customers that move, and a flow by country."""

    def __init__(self, spark, folder, **changes):
        self.spark, self.folder = spark, folder
        changes = {"checks": CheckPlan(min_history=99), **changes}
        self.spec = retail_spec(
            str(folder / "orders.csv"), str(folder / "customers.csv"), str(folder / "out"),
            mart_spec=COUNTRY_MART, **changes,
        )
        self.flow = Flow(spark, self.spec)

    def run(self, rows, people, **options):
        (self.folder / "orders.csv").write_text(plain.HEADER + rows)
        text = "".join(f"{k},{v or ''}\n" for k, v in people.items())
        (self.folder / "customers.csv").write_text("customer_id,country\n" + text)
        return self.flow.run(**options)

    def mart(self):
        return {(str(r["order_date"]), r["country"]): (r["total_revenue"], r["orders"]) for r in self.flow.mart().collect()}


def wanted(rows, people):
    groups = {}
    for r in plain.newest(plain.parsed(rows)):
        key = str(r["order_ts"].date()), people.get(r["customer_id"])
        total, count = groups.get(key, (0, 0))
        groups[key] = total + plain.cents(r["quantity"] * r["unit_price"]), count + 1
    return {k: (float(total), count) for k, (total, count) in groups.items()}


HOME = {"k-ana": "CL", "k-ben": "NZ", "k-eva": "FI", "k-ole": "FI"}
MOVED = {**HOME, "k-ana": "AR"}


def test_changes_of_a_dimension(spark):
    kind = "k string, a string, sign int"
    before = spark.createDataFrame([("same", "x", 1), ("nulls", None, None), ("gone", "x", 1), ("other", "x", 1), ("now null", "x", 1), (None, "x", 1)], kind)
    after = spark.createDataFrame([("same", "x", 1), ("nulls", None, None), ("new", "x", 1), ("other", "x", 2), ("now null", None, 1), (None, "y", 1)], kind)
    changed = dimension_changes(before, after, "k", ["a", "sign"])
    assert {r[0] for r in changed.collect()} == {"gone", "new", "other", "now null", None}
    assert changed.count() == 5
    facts = spark.createDataFrame([("gone", 1, 0), ("same", 2, 0), (None, 3, 0), ("new", 1, 0)], "k string, d int, changed_key int")
    assert [r[0] for r in days_of_keys(facts, "k", changed, "k", "d").collect()] == [1]


@pytest.mark.parametrize("buckets", [None, 4])
def test_customers_move_with_and_without_new_orders(spark, tmp_path, buckets):
    shop = Shop(spark, tmp_path, key_buckets=buckets)
    shop.run(WEEK1, HOME)
    assert shop.run(WEEK1, HOME).status == "no_new_data"
    assert shop.run(WEEK1 + WEEK2, MOVED).status == "success"
    assert shop.mart() == wanted(WEEK1 + WEEK2, MOVED)
    later = {**MOVED, "k-ole": None, "k-new": "PT"}
    del later["k-eva"]
    done = shop.run(WEEK1 + WEEK2, later)
    assert (done.status, done.rows_in_batch) == ("dimension_changed", 0)
    assert shop.mart() == wanted(WEEK1 + WEEK2, later)
    assert shop.run(WEEK1 + WEEK2, {**later, "k-far": "IS"}).status == "no_new_data"
    assert shop.run(WEEK1 + WEEK2 + WEEK3, {**later, "k-eva": "SE"}).status == "success"
    assert shop.mart() == wanted(WEEK1 + WEEK2 + WEEK3, {**later, "k-eva": "SE"})
    assert [r["rows_in_batch"] for r in volume_history(shop.flow.ledger()).collect()] == [4, 2, 1]


def test_days_of_other_customers_keep_their_files(spark, tmp_path):
    shop = Shop(spark, tmp_path, key_buckets=4)
    shop.run(WEEK1 + WEEK2, HOME)
    day = tmp_path / "out/curated/daily_category_revenue/order_date=2024-11-12"  # k-ole's
    before = sorted((f.name, f.stat().st_mtime_ns) for f in day.iterdir())
    assert shop.run(WEEK1 + WEEK2, MOVED).status == "dimension_changed"
    assert sorted((f.name, f.stat().st_mtime_ns) for f in day.iterdir()) == before


@pytest.mark.parametrize("step", ["before the mart is replaced", "before the last ledger row"])
@pytest.mark.parametrize("rows", [WEEK1, WEEK1 + WEEK2])
def test_a_run_that_breaks_off_shows_the_dimension_that_the_ledger_says(spark, tmp_path, monkeypatch, step, rows):
    """Customers move, the run breaks off, they move back; then a retry fails its checks, too."""
    shop = Shop(spark, tmp_path)
    shop.run(WEEK1, HOME)
    with monkeypatch.context() as patched:
        patched.setattr(*STEPS[step])
        with pytest.raises(Crash):
            shop.run(rows, MOVED)
    strict = dataclasses.replace(shop.spec, checks=CheckPlan(not_null=("category",), min_history=99))
    bad = WEEK1 + "g700,k-ben,2024-11-21 12:00:00,,1,9.99\n"
    with monkeypatch.context() as patched:
        patched.setattr(shop, "flow", Flow(spark, strict))
        with pytest.raises(BatchRejected):
            shop.run(bad, {**HOME, "k-ben": "AU"})
    assert shop.mart() == wanted(WEEK1, HOME)
    assert shop.run(WEEK1, HOME).status == "no_new_data"
    assert shop.mart() == wanted(WEEK1, HOME)
    shop.run(WEEK1 + WEEK2 + WEEK3, {**HOME, "k-eva": "SE"})
    assert shop.mart() == wanted(WEEK1 + WEEK2 + WEEK3, {**HOME, "k-eva": "SE"})
    assert last_run(shop.flow.ledger()).first()["status"] == "success"


@pytest.mark.parametrize("seed", range(2))
def test_any_batches_and_moves_give_the_mart_of_one_full_run(spark, tmp_path, seed):
    rnd = random.Random(seed)
    shop = Shop(spark, tmp_path, key_buckets=rnd.choice([None, 3]))
    keys = [f"c{k}" for k in range(6)]
    rows, people, minute = "", {k: rnd.choice(["A", "B", None]) for k in keys}, 0
    for turn in range(6):
        for _ in range(rnd.choice([0, 5, 12])):
            minute += rnd.randrange(1, 900)
            day, rest = divmod(minute, 1440)
            at = f"2024-12-{day % 28 + 1:02} {rest // 60:02}:{rest % 60:02}:00"
            rows += f"o{rnd.randrange(15)},{rnd.choice([*keys, 'stranger'])},{at},x,{rnd.randrange(1, 4)},{rnd.randrange(1, 90)}.25\n"
        for k in rnd.sample(keys, rnd.randrange(3)):
            people[k] = rnd.choice(["A", "B", "C", None])
        if rnd.random() < 0.4:
            people.pop(rnd.choice([*people]), None)
        shop.run(rows, people)
        assert shop.mart() == wanted(rows, people)
        if turn == 3:
            shop.flow.compact()
    shop.run(rows, people, full_refresh=True)
    assert shop.mart() == wanted(rows, people)


def test_a_mart_from_before_dimensions_were_stored(spark, tmp_path, monkeypatch):
    shop = Shop(spark, tmp_path)
    with monkeypatch.context() as patched:
        patched.setattr(Flow, "_store_dimension", lambda self, state: None)
        shop.run(WEEK1, HOME)
    assert shop.run(WEEK1, MOVED).status == "dimension_changed"
    assert shop.mart() == wanted(WEEK1, MOVED)
    assert shop.run(WEEK1, MOVED).status == "no_new_data"
