import datetime as dt
import random
import statistics
from decimal import Decimal

import plain
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from martflow.operators import (
    DAILY_CATEGORY_MART,
    BatchRejected,
    CheckPlan,
    CheckResult,
    CountDistinct,
    MartSpec,
    Money,
    Ratio,
    Reference,
    Sum,
    audit,
    batch_high,
    build_mart,
    collect_results,
    column_checks,
    gate,
    latest_per_key,
    lookup,
    not_known,
    orphan_keys,
    parse_time,
    reference_check,
    rejected_rows,
    rows_after,
    rows_on_days,
    scan_counts,
    touched_days,
    valid_rows,
    volume_check,
)
from martflow.sources import ORDERS

COLUMNS = "order_id string, customer_id string, order_ts string, category string, quantity int, unit_price double"
TIE = ("customer_id", "category", "quantity", "unit_price")


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def cleaned(df):
    return latest_per_key(valid_rows(parse_time(df, ORDERS), ORDERS.rules), ORDERS.key, ORDERS.time, TIE)


def kept(df):
    return {r["order_id"]: r for r in df.collect()}


# -- validity and versions -------------------------------------------------------


MONDAY, TUESDAY = "2024-06-03", "2024-06-04"


def test_invalid_rows_go_and_the_newest_version_stays(spark):
    text = (
        f"v1,p,{MONDAY} 07:00:00,tea,5,2.5\nv1,p,{MONDAY} 09:30:00,tea,8,2.5\nv1,p,{MONDAY} 08:00:00,tea,6,2.5\n"
        f"v2,,{MONDAY} 07:00:00,tea,1,4.0\nv3,q,{MONDAY} 07:00:00,salt,-2,4.0\nv4,q,{MONDAY} 07:00:00,salt,2,0\n"
        f"v5,q,soon,salt,2,1\nv6,q,{TUESDAY} 07:00:00,,2,1\n"
    )
    rows = plain.parsed(text)
    frame = orders(spark, *(
        (r["order_id"], r["customer_id"], r["order_ts"] and str(r["order_ts"]) or "soon", r["category"],
         r["quantity"], float(r["unit_price"])) for r in rows
    ))
    got = {k: (r["order_ts"], r["category"], r["quantity"]) for k, r in kept(cleaned(frame)).items()}
    assert got == {r["order_id"]: (r["order_ts"], r["category"], r["quantity"]) for r in plain.newest(rows)}
    assert set(got) == {"v1", "v6"}


def test_a_newer_invalid_version_does_not_hide_a_valid_one(spark):
    got = kept(cleaned(orders(
        spark,
        ("v1", "p", f"{MONDAY} 07:00:00", "tea", 5, 2.5),
        ("v1", "p", f"{TUESDAY} 07:00:00", "tea", 5, -2.5),
    )))
    assert got["v1"]["order_ts"] == dt.datetime(2024, 6, 3, 7)


@pytest.mark.parametrize("shuffled", [False, True])
def test_ties_do_not_depend_on_row_order(spark, shuffled):
    rows = [("v1", "p", f"{MONDAY} 07:00:00", "tea", q, 2.5) for q in range(1, 24)]
    df = orders(spark, *(reversed(rows) if shuffled else rows)).repartition(4)
    assert kept(cleaned(df))["v1"]["quantity"] == 23
    without_tiebreak = latest_per_key(parse_time(df, ORDERS), ORDERS.key, ORDERS.time)
    assert kept(without_tiebreak)["v1"]["quantity"] == 23


def test_null_times_sort_last(spark):
    df = orders(
        spark, ("v1", "p", None, "tea", 70, 2.5), ("v1", "p", f"{MONDAY} 07:00:00", "tea", 4, 2.5)
    )
    assert kept(latest_per_key(parse_time(df, ORDERS), ORDERS.key, ORDERS.time))["v1"]["quantity"] == 4


def test_rejected_rows_name_their_rules_and_complete_the_valid_ones(spark):
    at = f"{MONDAY} 07:00:00"
    df = parse_time(orders(
        spark,
        ("v1", "p", at, "tea", 5, 2.5),
        (None, None, at, "tea", None, 2.5),
        ("v3", "p", "31.12.2024", "salt", 1, 2.5),
        ("v4", "p", at, "salt", 1, float("nan")),
        ("v5", "p", at, "salt", 1, float("inf")),
        ("v6", "p", at, "salt", 2_000_000_000, 1e250),
    ), ORDERS)
    named = {r["order_id"]: r["failed_rules"] for r in rejected_rows(df, ORDERS.rules).collect()}
    assert named == {
        None: ["order_id_present", "customer_id_present", "quantity_positive", "revenue_finite"],
        "v3": ["time_parsed"],
        "v4": ["revenue_finite"],
        "v5": ["revenue_finite"],
    }
    assert valid_rows(df, ORDERS.rules).count() + len(named) == df.count()


@pytest.mark.parametrize(
    ("zone", "text", "clock"),
    [
        ("America/New_York", "2025-03-09 02:30:00", "2025-03-09 02:30:00"),  # a gap
        ("America/New_York", "2025-11-02 01:30:00", "2025-11-02 01:30:00"),  # an overlap
        ("Europe/Paris", "2025-03-30 02:15:00.25", "2025-03-30 02:15:00.250000"),
        ("Europe/Paris", "2025-10-26 02:15:00", "2025-10-26 02:15:00"),
        ("Europe/Paris", "2025-07-01 10:00:00+00:00", "2025-07-01 12:00:00"),  # an instant
        ("UTC", "2025-07-01T10:00:00Z", "2025-07-01 10:00:00"),
        ("UTC", "2025-07-01", "2025-07-01 00:00:00"),
        ("UTC", "2025-07-01 25:00:00", None),
        ("UTC", "", None),
    ],
)
def test_text_is_read_as_the_clock_shows_it(spark, zone, text, clock):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = parse_time(orders(spark, ("v1", "p", text, "tea", 1, 1.0)), ORDERS).first()["order_ts"]
        assert got == (clock and dt.datetime.fromisoformat(clock))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# -- cursor -------------------------------------------------------------------------


def ticks(spark):
    """One row every 40 minutes, from 6 in the morning."""
    start = dt.datetime(2024, 6, 3, 6)
    times = [start + dt.timedelta(minutes=40 * n) for n in range(9)]
    return orders(spark, *((f"t{n}", "p", str(t), "tea", 1, 1.0) for n, t in enumerate(times)))


def test_bounds_of_a_selection(spark):
    names = lambda **bounds: {int(k[1:]) for k in kept(rows_after(ticks(spark), column="order_ts", **bounds))}
    at = "2024-06-03 08:00:00"  # the time of t3
    assert names(cursor=None) == set(range(9))
    assert names(cursor=at) == {4, 5, 6, 7, 8}
    assert names(cursor=at, lookback="80 minutes") == {2, 3, 4, 5, 6, 7, 8}
    assert names(cursor=at, upto="2024-06-03 09:20:00") == {4, 5}
    assert names(cursor="2024-06-03 11:20:00") == set()


def test_rows_without_a_time_pass_a_cursor_only_if_asked(spark):
    df = orders(spark, ("v1", "p", "whenever", "tea", 1, 5.0))
    assert rows_after(df, None, "order_ts").count() == 1
    assert rows_after(df, f"{MONDAY} 10:00:00", "order_ts").count() == 0
    assert rows_after(df, f"{MONDAY} 10:00:00", "order_ts", unreadable=True).count() == 1


def test_rows_that_known_versions_beat_are_dropped(spark):
    at = lambda h: f"{MONDAY} {h:02}:00:00"
    known = parse_time(orders(
        spark, ("v1", "p", at(9), "tea", 2, 1.0), ("v2", "p", at(9), "tea", 2, 1.0), ("v3", "p", at(2), "tea", 2, 1.0)
    ), ORDERS)
    rows = parse_time(orders(
        spark,
        ("v1", "p", at(9), "tea", 2, 1.0),  # the same again
        ("v2", "p", at(8), "tea", 5, 1.0),  # overtaken
        ("v2", "p", at(9), "tea", 3, 1.0),  # wins its tie
        ("v3", "p", at(7), "tea", 2, 1.0),  # newer than what is known
        ("v4", "p", at(6), "tea", 2, 1.0),  # unknown
        ("v1", "p", at(11), "tea", 2, 1.0),  # beyond the cursor
        (None, "p", at(6), "tea", 2, 1.0),
        ("v5", "p", "never", "tea", 2, 1.0),
    ), ORDERS)
    got = not_known(rows, known, ORDERS.key, ORDERS.time, ORDERS.ties, at(10)).collect()
    assert sorted((r["order_id"], r["order_ts"] and r["order_ts"].hour, r["quantity"]) for r in got if r["order_id"]) == [
        ("v1", 11, 2), ("v2", 9, 3), ("v3", 7, 2), ("v4", 6, 2), ("v5", None, 2),
    ]
    assert len(got) == 6


def high(df):
    return batch_high(df, "order_ts").first()[0]


def test_high_watermark(spark):
    assert high(ticks(spark)) == "2024-06-03 11:20:00"
    assert high(ticks(spark).limit(0)) is None
    assert high(orders(spark, ("v1", "p", "whenever", "tea", 1, 5.0))) is None


@pytest.mark.parametrize("kind", [TimestampNTZType(), TimestampType()])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_the_cursor_is_exact_in_every_zone(spark, kind, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT '2025-11-02 01:30:00.500001' AS order_ts").select(
            F.col("order_ts").cast(kind)
        )
        mark = high(df)
        assert rows_after(df, mark, "order_ts").count() == 0
        assert rows_after(df, None, "order_ts", upto=mark).count() == 1
        spark.conf.set("spark.sql.session.timeZone", "UTC" if kind == TimestampNTZType() else zone)
        assert rows_after(df, mark, "order_ts").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_days(spark):
    two = ticks(spark).unionByName(orders(spark, ("u1", "p", f"{TUESDAY} 01:00:00", "tea", 1, 1.0)))
    df = parse_time(two, ORDERS)
    days = touched_days(df, "order_date")
    assert {str(r[0]) for r in days.collect()} == {MONDAY, TUESDAY}
    assert set(kept(rows_on_days(df, days.filter(f"order_date > '{MONDAY}'"), "order_date"))) == {"u1"}
    assert rows_on_days(df, days.limit(0), "order_date").count() == 0


# -- lookup ------------------------------------------------------------------------------


def test_lookup_keeps_unmatched_facts_and_never_multiplies(spark):
    facts = spark.createDataFrame([("A", "c1"), ("B", "c9"), ("C", None)], "order_id string, customer_id string")
    dims = spark.createDataFrame([("c1", "ES"), ("c1", "PT"), (None, "FR")], "customer_id string, country string")
    got = kept(lookup(facts, dims, "customer_id", "customer_id", ["country"]))
    assert {k: r["country"] for k, r in got.items()} == {"A": "PT", "B": None, "C": None}


def test_a_null_fact_key_is_one_orphan(spark):
    facts = spark.createDataFrame([("c1",), ("c9",), ("c9",), (None,), (None,)], "customer_id string")
    dims = spark.createDataFrame([("c1",), (None,)], "id string")
    got = [r[0] for r in orphan_keys(facts, "customer_id", dims, "id").collect()]
    assert sorted(got, key=str) == [None, "c9"]


# -- mart ----------------------------------------------------------------------------------


def mart_of(spark, text):
    rows = [(r["order_id"], r["customer_id"], str(r["order_ts"]), r["category"], r["quantity"], float(r["unit_price"]))
            for r in plain.parsed(text)]
    mart = build_mart(cleaned(orders(spark, *rows)), DAILY_CATEGORY_MART, ORDERS.key)
    return {(str(r[0]), r[1]): tuple(r)[2:] for r in mart.collect()}


def test_mart_measures_of_random_orders(spark):
    turn = random.Random(20)
    text = "".join(
        f"r{turn.randrange(60)},p{turn.randrange(9)},2024-06-{turn.randrange(3, 6):02} {turn.randrange(24):02}:{n // 60:02}:{n % 60:02},"
        f"{turn.choice(['tea', 'salt', ''])},{turn.randrange(0, 7)},{turn.randrange(1, 4000) / 100}\n"
        for n in range(200)
    )
    assert mart_of(spark, text) == plain.mart(text)


def test_amounts_round_half_up_on_their_decimal_text(spark):
    text = "".join(
        f"h{n},p,{MONDAY} 07:00:00,tea,{q},{price}\n"
        for n, (q, price) in enumerate([(1, "2.675"), (1, "1.115"), (1, "0.045"), (1, "0.1"), (1, "0.2"), (1, "1.0049")])
    )
    assert mart_of(spark, text) == plain.mart(text)


def test_sums_of_amounts_of_any_size_are_exact(spark):
    values = [0.01, 999_999.99, 1e6, 1_000_000.01, 4e13, 9e15, 123456789012.35, -5e14, -0.01, 7e20]
    rows = spark.createDataFrame([(v,) for v in values * 50], "v double").withColumn("d", F.lit("x"))
    spec = MartSpec("d", ("d",), (Money("total", "v"), Sum("n", "one")), derived={"one": lambda: F.lit(1)})
    want = sum(Decimal(repr(v)) for v in values) * 50
    assert build_mart(rows.repartition(7), spec).first()["total"] == float(want)


def test_ratios_of_every_kind(spark):
    spec = MartSpec(
        "d", ("d",),
        (
            Money("revenue", "v"), Money("cost", "c"), CountDistinct("orders", "o"), Sum("units", "u"),
            Sum("weight", "w"), Money("none", "z"),
            Ratio("per_order", "revenue", "orders"), Ratio("margin", "revenue", "cost", 4),
            Ratio("units_per_order", "units", "orders", 1), Ratio("units_per_money", "units", "revenue", 3),
            Ratio("weight_per_unit", "weight", "units", 2), Ratio("per_weight", "revenue", "weight"),
            Ratio("over_null", "revenue", "none"), Ratio("over_zero", "units", "zero"), Sum("zero", "k"),
        ),
        derived={"z": lambda: F.lit(None).cast("double"), "k": lambda: F.lit(0)},
    )
    rows = spark.createDataFrame(
        [("x", 3.35, 2.0, "a", 4, 0.5), ("x", 6.70, 1.0, "b", 3, 0.25)], "d string, v double, c double, o string, u int, w double"
    )
    got = build_mart(rows, spec).first().asDict()
    assert {k: got[k] for k in got if k in {m.name for m in spec.measures if isinstance(m, Ratio)}} == {
        "per_order": 5.03, "margin": 3.35, "units_per_order": 3.5, "units_per_money": 0.697,
        "weight_per_unit": 0.11, "per_weight": 13.4, "over_null": None, "over_zero": None,
    }


def test_distinct_counts_agree_however_they_are_planned(spark):
    rows = spark.range(500).selectExpr(
        "id % 3 AS d", "CAST(id % 90 AS string) AS o", "CAST((id % 90) % 7 AS string) AS c", "id / 8D AS v"
    ).withColumn("o", F.nullif("o", F.lit("4")))
    measures = (Money("total", "v"), CountDistinct("orders", "o"), CountDistinct("people", "c"), Sum("n", "v"))
    free = build_mart(rows, MartSpec("d", ("d",), measures))
    told = build_mart(rows, MartSpec("d", ("d",), measures, determines={"o": ("c",)}))
    assert free.exceptAll(told).count() == told.exceptAll(free).count() == 0
    assert "Expand" in free._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in told._jdf.queryExecution().executedPlan().toString()


# -- checks ----------------------------------------------------------------------------------


def outcome(report):
    return {c.name: (c.passed, c.detail) for c in collect_results(report)}


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (None, "b"), (-1, None)], "x int, id string")
    got = outcome(column_checks(df, not_null=["x", "id"], unique=["x", "id", ("x", "id")], non_negative=["x"]))
    assert got == {
        "not_null[x]": (False, "2 null value(s)"),
        "not_null[id]": (False, "1 null value(s)"),
        "unique[x]": (False, "1 repeated row(s)"),
        "unique[id]": (False, "1 repeated row(s)"),
        "unique[x,id]": (True, "0 repeated row(s)"),
        "non_negative[x]": (False, "1 value(s) below zero"),
    }


def test_column_checks_pass_on_no_rows(spark):
    empty = spark.createDataFrame([], "x int")
    got = column_checks(empty, not_null=["x"], unique=["x"], non_negative=["x"])
    assert all(c.passed for c in collect_results(got))


def test_zero_null_and_nan_are_not_negative(spark):
    df = spark.createDataFrame([(0.0,), (None,), (float("nan"),)], "x double")
    assert outcome(column_checks(df, non_negative=["x"]))["non_negative[x]"][0]


def test_references(spark):
    facts = spark.createDataFrame([(n % 11,) for n in range(40)] + [(None,)], "part int")
    dims = spark.createDataFrame([(n,) for n in range(0, 11, 2)], "id int")
    name = "referential_integrity[part->id]"
    assert outcome(reference_check(facts, "part", dims, "id")) == {name: (False, "6 key(s) without a match")}
    even = facts.filter("part % 2 = 0")
    assert outcome(reference_check(even, "part", dims, "id"))[name][0]


@pytest.mark.parametrize("tolerance", [0.5, 0.1])
def test_volume_against_the_median(spark, tolerance):
    turn = random.Random(8)
    for _ in range(12):
        history = [turn.choice([0, 40, 55, 70, 300]) for _ in range(turn.randrange(0, 8))]
        baseline = statistics.median(history) if history else 0
        low, high = baseline * (1 - tolerance), baseline * (1 + tolerance)
        frame = spark.createDataFrame([(n,) for n in history], "rows_in_batch long")
        for current in {0, int(low), int(low) - 1, round(baseline), int(high), int(high) + 1}:
            result = collect_results(volume_check(frame, current, tolerance=tolerance))[0]
            passes = len(history) < 3 or baseline <= 0 or low <= current <= high
            assert (result.name, result.passed) == ("volume_anomaly", passes), (history, current)
            assert passes or "baseline" in result.detail


def test_the_gate_names_every_failure():
    good, bad, worse = (CheckResult(n, n == "a", f"{n}!") for n in "abc")
    assert gate([good]) == [good]
    with pytest.raises(BatchRejected) as caught:
        gate([good, bad, worse])
    assert caught.value.failures == [bad, worse]
    assert "b!" in str(caught.value) and "c!" in str(caught.value)


@pytest.mark.parametrize("rows", [
    [],
    [(None, 1), (None, 1), (None, None)],
    [("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1)],
])
def test_repeated_rows_are_counted_in_one_pass(spark, rows):
    df = spark.createDataFrame(rows, "_n string, m int")
    found = {c.name: c.detail for c in collect_results(column_checks(df, unique=("_n", ("_n", "m"))))}
    assert found == {
        "unique[_n]": f"{len(rows) - len({r[0] for r in rows})} repeated row(s)",
        "unique[_n,m]": f"{len(rows) - len(set(rows))} repeated row(s)",
    }


def test_the_audit_does_not_count_again_what_a_write_has_counted(spark):
    batch = spark.createDataFrame([("A", -1.0), ("A", 2.0), (None, None)], "order_id string, unit_price double")
    plan = CheckPlan(not_null=("order_id",), unique=("order_id",), non_negative=("unit_price",))
    measured = batch.agg(*(found.alias(name) for name, found in scan_counts(plan).items())).first().asDict()
    assert measured == {"rows": 3, "not_null[order_id]": 1, "non_negative[unit_price]": 1}
    assert audit(batch, plan, (0, None), measured=measured).first() == audit(batch, plan, (0, None)).first()
    other = audit(batch, plan, (0, None), measured=measured | {"rows": 7, "not_null[order_id]": 0}).first()
    assert other["rows"] == 7 and other["checks"][0]["passed"]


def test_the_audit_gives_all_checks_in_one_row(spark):
    batch = spark.createDataFrame([("A", "c1", 1.0), ("B", "c9", -1.0)], "order_id string, customer_id string, unit_price double")
    dims = spark.createDataFrame([("c1",), ("c1",)], "customer_id string")
    history = spark.createDataFrame([(n,) for n in (10, 10, 10)], "rows_in_batch long")
    plan = CheckPlan(
        not_null=("order_id",), unique=("order_id",), non_negative=("unit_price",),
        reference=Reference("customer_id", "customer_id"), dimension_unique=True,
    )
    row = audit(batch, plan, history, dims).first()
    assert row["rows"] == 2
    assert [(c["name"], c["passed"]) for c in row["checks"]] == [
        ("not_null[order_id]", True),
        ("unique[order_id]", True),
        ("non_negative[unit_price]", False),
        ("referential_integrity[customer_id->customer_id]", False),
        ("dimension_unique[customer_id]", False),
        ("volume_anomaly", False),
    ]
