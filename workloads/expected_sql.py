"""Expected results as SQL over the same tables, worded independently of the queries."""

from __future__ import annotations

from .queries import CURSOR, EVENT_CUTS, LINE_CURSOR, LINE_CUTS

ORDERS = """
raw AS (
  SELECT event_id AS order_id, user_id AS customer_id, ts AS order_ts, event_type AS category,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity, value AS unit_price
  FROM events),
parsed AS (SELECT *, CAST(order_ts AS DATE) AS order_date FROM raw),
valid AS (
  SELECT * FROM parsed
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0
    AND isfinite(quantity * unit_price) AND order_ts IS NOT NULL),
clean AS (
  SELECT * EXCLUDE (v) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_ts DESC NULLS LAST,
      customer_id DESC NULLS LAST, category DESC NULLS LAST, quantity DESC NULLS LAST,
      unit_price DESC NULLS LAST) AS v
    FROM valid) WHERE v = 1),
priced AS (
  SELECT *, CAST(quantity * CAST(unit_price AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS revenue
  FROM clean)
"""

PEOPLE = """
people AS (
  SELECT c_custkey AS customer_id, n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
"""

LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_quantity,
         l_extendedprice, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month
  FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity > 0
    AND l_extendedprice > 0 AND l_shipdate IS NOT NULL),
newest AS (
  SELECT * EXCLUDE (v) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS v
    FROM lines) WHERE v = 1)
"""


def _moved(name: str, time: int) -> str:
    """The customers of a time, some of whom have moved."""
    known = "TRUE" if time > 1 else "c_custkey % 11 <> 3"
    return f"""
{name} AS (
  SELECT c_custkey AS customer_id, n_name AS country
  FROM customer LEFT JOIN nation ON n_nationkey =
    CASE WHEN c_custkey % 5 < {time} THEN (c_nationkey + {time}) % 25 ELSE c_nationkey END
  WHERE {known})"""


def _half_up_cents(total: str, count: str) -> str:
    """A quotient rounded half-up to cents in whole numbers, free of floating point."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + {count}) // (2 * {count}) AS DOUBLE) / 100"


def _half_up(top: str, bottom: str, scale: int) -> str:
    """A quotient of whole numbers, rounded half-up to ``scale`` places."""
    power = 10**scale
    return f"CAST((2 * CAST({top} AS HUGEINT) * {power} + {bottom}) // (2 * {bottom}) AS DOUBLE) / {power}"


def _mart(source: str, grain: str, revenue: str, order_id: str, buyer: str, units: str, name: str) -> str:
    return f"""
  SELECT {grain}, CAST(sum({revenue}) AS DOUBLE) AS total_revenue,
         count(DISTINCT {order_id}) AS orders, count(DISTINCT {buyer}) AS {name},
         CAST(sum({units}) AS {"BIGINT" if units == "quantity" else "DOUBLE"}) AS units,
         {_half_up_cents(f"sum({revenue})", f"count(DISTINCT {order_id})")} AS avg_order_value
  FROM {source} GROUP BY {grain}"""


DAILY = _mart("priced", "order_date, category", "revenue", "order_id", "customer_id", "quantity", "customers")
MONTHLY = _mart(
    "newest", "ship_month, l_returnflag", "CAST(l_extendedprice AS DECIMAL(18,2))", "l_orderkey",
    "l_partkey", "l_quantity", "parts",
)


def _bounds(cuts) -> list[tuple[str, str]]:
    """Lower (exclusive) and upper (inclusive) time of each batch."""
    marks = ["0001-01-01 00:00:00", *cuts, "9999-01-01 00:00:00"]
    return list(zip(marks, marks[1:]))


EVENT_BATCHES = "batches(run_seq, low, high) AS (VALUES " + ", ".join(
    f"(CAST({n} AS BIGINT), TIMESTAMP '{low}', TIMESTAMP '{high}')"
    for n, (low, high) in enumerate(_bounds(EVENT_CUTS), 1)
) + ")"

DAY_COUNTS = "counts AS (SELECT order_date, count(*) AS rows_in_batch FROM parsed GROUP BY order_date)"


def _verdict(tolerance: str) -> str:
    low, high = f"baseline * (1 - {tolerance})", f"baseline * (1 + {tolerance})"

    def text(x: str) -> str:
        return f"CAST(CAST({x} AS DECIMAL(20,2)) AS VARCHAR)"

    return f"""
    runs < 3 OR baseline <= 0 OR rows_in_batch BETWEEN {low} AND {high} AS passed,
    CASE WHEN runs < 3 THEN 'only ' || runs || ' of 3 earlier counts'
         WHEN baseline <= 0 THEN 'baseline is ' || {text("baseline")}
         ELSE rows_in_batch || ' rows; baseline ' || {text("baseline")} || ', accepted '
              || {text(low)} || ' to ' || {text(high)} END AS detail"""


def _running(frame: str) -> str:
    over = f"OVER (ORDER BY order_date ROWS BETWEEN {frame} PRECEDING AND 1 PRECEDING)"
    return f"""
  SELECT order_date, rows_in_batch, count(rows_in_batch) {over} AS runs,
         CAST(median(rows_in_batch) {over} AS DOUBLE) AS baseline
  FROM counts"""


NEWEST_DAY = f"""
  SELECT 'volume_anomaly' AS name, {_verdict("0.5")}
  FROM (SELECT * FROM ({_running("UNBOUNDED")}) ORDER BY order_date DESC LIMIT 1)"""


def _check(name: str, count: str, noun: str, source: str) -> str:
    return f"""
  SELECT '{name}' AS name, n = 0 AS passed, n || ' {noun}' AS detail
  FROM (SELECT {count} AS n FROM {source})"""


ORPHAN_ORDERS = """
  SELECT DISTINCT o_orderkey FROM orders
  WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""

BATCH_DAYS = f"""
WITH {ORDERS}, {{batches}}
SELECT run_seq AS batch_id, order_date, count(*) AS n
FROM clean JOIN batches ON order_ts > low AND order_ts <= high
GROUP BY run_seq, order_date"""

ONE_BATCH = "batches(run_seq, low, high) AS (VALUES (CAST(1 AS BIGINT), TIMESTAMP '0001-01-01', TIMESTAMP '9999-01-01'))"

EXPECTED: dict[str, str] = {
    "daily_mart": f"WITH {ORDERS} {DAILY}",
    "scan_contract": f"WITH {ORDERS} SELECT * FROM raw",
    "csv_contract": f"""
WITH {ORDERS}
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_ts,
       category, quantity, unit_price, order_date
FROM parsed""",
    "parse_timestamps": f"""
WITH {ORDERS}, texts AS (
  SELECT order_id, CASE WHEN category = 'error' THEN 'at ' || CAST(order_ts AS VARCHAR)
                        ELSE CAST(order_ts AS VARCHAR) END AS t FROM raw)
SELECT order_id, TRY_CAST(t AS TIMESTAMP) AS order_ts, CAST(TRY_CAST(t AS TIMESTAMP) AS DATE) AS order_date
FROM texts""",
    "valid_rows": f"WITH {ORDERS} SELECT * FROM valid",
    "rejected_rows": f"""
WITH {ORDERS}
SELECT *, concat_ws(',',
    CASE WHEN order_id IS NULL THEN 'order_id_present' END,
    CASE WHEN customer_id IS NULL THEN 'customer_id_present' END,
    CASE WHEN NOT coalesce(quantity > 0, false) THEN 'quantity_positive' END,
    CASE WHEN NOT coalesce(unit_price > 0, false) THEN 'unit_price_positive' END,
    CASE WHEN NOT coalesce(isfinite(quantity * unit_price), false) THEN 'revenue_finite' END,
    CASE WHEN order_ts IS NULL THEN 'time_parsed' END) AS failed_rules
FROM parsed WHERE NOT EXISTS (SELECT 1 FROM valid WHERE valid.order_id = parsed.order_id)""",
    "latest_per_key": f"WITH {LINES} SELECT * FROM newest",
    "select_new": f"WITH {ORDERS} SELECT * FROM raw WHERE order_ts > TIMESTAMP '{CURSOR}'",
    "select_new_lookback": f"""
WITH {ORDERS} SELECT * FROM raw WHERE order_ts > TIMESTAMP '{CURSOR}' - INTERVAL 36 HOUR""",
    "high_watermark": "SELECT CAST(max(ts) AS VARCHAR) AS high_watermark FROM events",
    "touched_days": f"""
WITH {ORDERS} SELECT DISTINCT order_date FROM parsed WHERE order_ts > TIMESTAMP '{CURSOR}'""",
    "touched_days_filter": f"""
WITH {ORDERS}
SELECT * FROM valid WHERE order_date IN (
  SELECT order_date FROM (
    SELECT order_date, row_number() OVER (
      PARTITION BY category ORDER BY unit_price DESC, order_id DESC) AS r FROM valid)
  WHERE r = 1)""",
    "affected_days": f"""
WITH {LINES}, late AS (
  SELECT l_orderkey, l_linenumber, max(ship_month) AS ship_month
  FROM lines WHERE l_shipdate > TIMESTAMP '{LINE_CURSOR}' GROUP BY l_orderkey, l_linenumber)
SELECT ship_month FROM late
UNION
SELECT l.ship_month FROM lines l JOIN late USING (l_orderkey, l_linenumber)
WHERE l.l_shipdate <= TIMESTAMP '{LINE_CURSOR}'""",
    "rebuild_affected": f"""
WITH {LINES}, peaks AS (
  SELECT l_returnflag, year(ship_month) AS y, ship_month, count(*) AS n FROM lines GROUP BY ALL)
SELECT * FROM newest WHERE ship_month IN (
  SELECT ship_month FROM (SELECT ship_month, row_number() OVER (
    PARTITION BY l_returnflag, y ORDER BY n DESC, ship_month DESC) AS r FROM peaks) WHERE r = 1)""",
    "revenue_projection": f"""
WITH {ORDERS}
SELECT order_id, CAST(quantity * CAST(unit_price AS DECIMAL(18,2)) AS DOUBLE) AS revenue FROM valid""",
    "enrich_left": f"""
WITH {ORDERS}, {PEOPLE}
SELECT order_id, v.customer_id,
       CAST(quantity * CAST(unit_price AS DECIMAL(18,2)) AS DOUBLE) AS revenue, country
FROM valid v LEFT JOIN people p ON v.customer_id = p.customer_id""",
    "enrich_unmatched": """
SELECT o_orderkey, o_custkey, l_shipdate, l_returnflag
FROM orders LEFT JOIN (
  SELECT * FROM (SELECT l_orderkey, l_shipdate, l_returnflag, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_returnflag DESC) AS r FROM lineitem)
  WHERE r = 1) ON o_orderkey = l_orderkey""",
    "orphans_anti": ORPHAN_ORDERS,
    "distinct_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "country_mart": f"WITH {ORDERS}, {PEOPLE}"
    + _mart(
        "(SELECT priced.*, country FROM priced LEFT JOIN people USING (customer_id))",
        "order_date, country", "revenue", "order_id", "customer_id", "quantity", "customers",
    ),
    "brand_mart": "WITH facts AS (SELECT *, CAST(o_orderdate AS DATE) AS order_date FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"
    + _mart(
        "facts", "order_date, p_brand", "CAST(l_extendedprice AS DECIMAL(18,2))", "l_orderkey",
        "o_custkey", "l_quantity", "customers",
    ),
    "check_not_null": f"WITH {ORDERS}"
    + _check("not_null[quantity]", "count(*) - count(nullif(quantity, 0))", "null value(s)", "raw")
    + " UNION ALL "
    + _check("not_null[order_id]", "count(*) - count(order_id)", "null value(s)", "raw"),
    "check_non_negative": _check(
        "non_negative[c_acctbal]", "count(*) FILTER (c_acctbal < 0)", "value(s) below zero", "customer"
    )
    + " UNION ALL "
    + _check(
        "non_negative[c_nationkey]", "count(*) FILTER (c_nationkey < 0)", "value(s) below zero", "customer"
    ),
    "check_unique": _check(
        "unique[l_orderkey,l_linenumber]", "(SELECT count(*) FROM lineitem) - count(*)",
        "repeated row(s)", "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
    )
    + " UNION ALL "
    + _check(
        "unique[l_quantity]", "(SELECT count(*) FROM lineitem) - count(*)", "repeated row(s)",
        "(SELECT DISTINCT nullif(l_quantity, 1) FROM lineitem)",
    ),
    "check_referential": _check(
        "referential_integrity[o_orderkey->l_orderkey]", "count(*)", "key(s) without a match", f"({ORPHAN_ORDERS})"
    )
    + " UNION ALL "
    + _check(
        "referential_integrity[l_orderkey->o_orderkey]", "count(*)", "key(s) without a match",
        "(SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IS NULL"
        " OR l_orderkey NOT IN (SELECT o_orderkey FROM orders))",
    ),
    "volume_baseline": f"WITH {ORDERS}, {DAY_COUNTS} {_running('UNBOUNDED')}",
    "check_volume": f"WITH {ORDERS}, {DAY_COUNTS} {NEWEST_DAY}",
    "volume_anomaly_by_day": f"""
WITH {ORDERS}, {DAY_COUNTS}
SELECT order_date, rows_in_batch, {_verdict("0.02")} FROM ({_running("7")})""",
    "quality_report": f"WITH {ORDERS}, {DAY_COUNTS}"
    + _check("not_null[l_orderkey]", "count(*) - count(l_orderkey)", "null value(s)", "lineitem")
    + " UNION ALL "
    + _check(
        "unique[l_orderkey,l_linenumber]", "(SELECT count(*) FROM lineitem) - count(*)",
        "repeated row(s)", "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
    )
    + " UNION ALL "
    + _check(
        "non_negative[gain]", "count(*) FILTER (l_extendedprice - 1000 < 0)", "value(s) below zero",
        "lineitem",
    )
    + " UNION ALL "
    + _check(
        "referential_integrity[o_orderkey->l_orderkey]", "count(*)", "key(s) without a match", f"({ORPHAN_ORDERS})"
    )
    + f" UNION ALL {NEWEST_DAY}",
    "first_load": BATCH_DAYS.format(batches=ONE_BATCH),
    "append_batches": BATCH_DAYS.format(batches=EVENT_BATCHES),
    "clean_layer_roundtrip": f"WITH {ORDERS} SELECT * FROM clean",
    "dynamic_overwrite": f"""
WITH {ORDERS}
SELECT * REPLACE (CASE WHEN isodow(order_date) = 1 THEN -units ELSE units END AS units) FROM ({DAILY})""",
    "emptied_days": f"WITH {ORDERS} SELECT * FROM ({DAILY}) WHERE isodow(order_date) <> 1",
    "full_refresh_rebuild": f"WITH {ORDERS} {DAILY}",
    "ledger_watermark": "SELECT CAST(max(ts) AS VARCHAR) AS watermark FROM events",
    "ledger_volumes": f"""
WITH {ORDERS}, {EVENT_BATCHES}
SELECT run_seq, count(*) AS rows_in_batch
FROM clean JOIN batches ON order_ts > low AND order_ts <= high GROUP BY run_seq""",
    "ledger_last_run": """
SELECT CAST(5 AS BIGINT) AS run_seq, 'no_new_data' AS status, 'incremental' AS mode,
       CAST(0 AS BIGINT) AS rows_read, CAST(0 AS BIGINT) AS rows_in_batch,
       CAST(max(ts) AS VARCHAR) AS watermark_before, CAST(max(ts) AS VARCHAR) AS watermark_after,
       CAST(0 AS BIGINT) AS n_checks
FROM events""",
    "ledger_runs": f"""
WITH {ORDERS}, {EVENT_BATCHES}, runs AS (
  SELECT run_seq, count(*) AS rows_read,
         count(*) FILTER (NOT (quantity > 0 AND unit_price > 0)) AS rows_rejected,
         CAST(max(order_ts) AS VARCHAR) AS watermark_after
  FROM parsed JOIN batches ON order_ts > low AND order_ts <= high GROUP BY run_seq),
batch AS (SELECT run_seq, clean.* FROM clean JOIN batches ON order_ts > low AND order_ts <= high),
sizes AS (SELECT run_seq, count(*) AS n FROM batch GROUP BY run_seq),
verdicts AS (
  SELECT run_seq, 'not_null[order_id]' AS name, count(*) = count(order_id) AS passed FROM batch GROUP BY run_seq
  UNION ALL
  SELECT run_seq, 'unique[order_id]', count(*) = count(DISTINCT order_id) FROM batch GROUP BY run_seq
  UNION ALL
  SELECT run_seq, 'non_negative[unit_price]', min(unit_price) >= 0 FROM batch GROUP BY run_seq
  UNION ALL
  SELECT run_seq, 'referential_integrity[customer_id->customer_id]',
         bool_and(customer_id IN (SELECT c_custkey FROM customer)) FROM batch GROUP BY run_seq
  UNION ALL
  SELECT s.run_seq, 'volume_anomaly', count(e.n) < 3 OR s.n BETWEEN median(e.n) * 0.5 AND median(e.n) * 1.5
  FROM sizes s LEFT JOIN sizes e ON e.run_seq < s.run_seq GROUP BY s.run_seq, s.n)
SELECT runs.*, name, passed FROM runs JOIN verdicts USING (run_seq)""",
    "latest_across_batches": f"WITH {LINES} SELECT * FROM newest",
    "incremental_mart": f"WITH {LINES} {MONTHLY}",
    "incremental_equals_full": f"""
WITH {LINES}
SELECT count(*) AS mart_groups, CAST(0 AS BIGINT) AS differing_groups
FROM (SELECT DISTINCT ship_month, l_returnflag FROM newest)""",
    "large_amounts": f"""
WITH {LINES}
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders,
       CAST(CAST(sum(CAST(l_extendedprice * 1e9 AS DECIMAL(38,2))) AS VARCHAR) AS DOUBLE) AS total_revenue
FROM lines GROUP BY l_returnflag""",
    "ratio_measures": f"""
WITH sums AS (
  SELECT nullif(l_returnflag, 'N') AS flag, count(DISTINCT l_orderkey) AS orders,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue,
         sum(CAST(floor(l_extendedprice) AS BIGINT)) AS whole, sum(CAST(l_quantity AS BIGINT)) AS pieces
  FROM lineitem GROUP BY 1)
SELECT flag, CAST(revenue AS DOUBLE) AS revenue, CAST(whole AS DOUBLE) AS whole_revenue, orders,
       CAST(pieces AS BIGINT) AS pieces, CAST(0 AS BIGINT) AS nothing,
       {_half_up_cents("revenue", "orders")} AS per_order,
       {_half_up("whole * 100", "CAST(revenue * 100 AS HUGEINT)", 6)} AS share,
       {_half_up("pieces", "orders", 3)} AS pieces_per_order, CAST(NULL AS DOUBLE) AS per_nothing
FROM sums""",
    "customers_contract": f"""
WITH {PEOPLE}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, country, CAST(NULL AS VARCHAR) AS signup_date
FROM people""",
    "malformed_lines": f"""
WITH {ORDERS}
SELECT CAST(order_id AS VARCHAR) AS order_id, category,
       CASE WHEN category = 'error' THEN NULL ELSE quantity END AS quantity,
       CASE WHEN category = 'error' THEN 'about ' || quantity END AS quantity_text
FROM raw""",
    "gate_stops_run": f"""
WITH {LINES}, early AS (SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '{LINE_CUTS[0]}'),
known AS (SELECT * FROM lines WHERE l_shipdate <= TIMESTAMP '{LINE_CUTS[0]}'),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS v FROM known QUALIFY v = 1),
missing AS (
  SELECT count(DISTINCT l_orderkey) AS n FROM lines
  WHERE l_shipdate > TIMESTAMP '{LINE_CUTS[0]}' AND l_orderkey NOT IN (SELECT l_orderkey FROM early))
SELECT CAST(1 AS BIGINT) AS runs,
       (SELECT 'referential_integrity[l_orderkey->l_orderkey]: ' || n || ' key(s) without a match'
        FROM missing) AS failures,
       (SELECT count(*) FROM kept) AS clean_rows,
       (SELECT count(*) FROM (SELECT DISTINCT ship_month, l_returnflag FROM kept)) AS mart_groups,
       CAST((SELECT sum(n) FROM (SELECT count(DISTINCT l_orderkey) AS n FROM kept
                                 GROUP BY ship_month, l_returnflag)) AS BIGINT) AS orders""",
    "refresh_to_empty": f"""
WITH {ORDERS}
SELECT CAST(1 AS BIGINT) AS run_seq, 'incremental' AS mode, (SELECT count(*) FROM clean) AS rows_in_batch,
       (SELECT CAST(max(order_ts) AS VARCHAR) FROM parsed) AS watermark_after, CAST(0 AS BIGINT) AS mart_groups
UNION ALL
SELECT CAST(2 AS BIGINT), 'full_refresh', CAST(0 AS BIGINT), NULL, CAST(0 AS BIGINT)""",
    "lookback_runs": f"""
WITH {ORDERS}, late AS (
  SELECT * FROM parsed
  WHERE order_id % 50 = 7 AND order_ts < (SELECT max(order_ts) FROM parsed)
    AND order_ts > (SELECT max(order_ts) FROM parsed) - INTERVAL 36 HOUR),
good AS (SELECT order_id FROM late SEMI JOIN valid USING (order_id)),
newest AS (SELECT CAST(max(order_ts) AS VARCHAR) AS t FROM parsed)
SELECT CAST(1 AS BIGINT) AS run_seq, 'success' AS status,
       (SELECT count(*) FROM parsed) - (SELECT count(*) FROM late) AS rows_read,
       (SELECT count(*) FROM clean) - (SELECT count(*) FROM good) AS rows_in_batch, t AS watermark_after
FROM newest
UNION ALL
SELECT CAST(n AS BIGINT), 'no_new_data', CAST(0 AS BIGINT), CAST(0 AS BIGINT), t
FROM newest, (VALUES (2), (3)) AS again(n)
UNION ALL
SELECT CAST(4 AS BIGINT), 'success', (SELECT count(*) FROM good), (SELECT count(*) FROM good), t FROM newest""",
    "merged_batches": f"""
WITH {ORDERS}, {EVENT_BATCHES}
SELECT (SELECT max(run_seq) FROM batches) AS batch_id, order_date, count(*) AS n FROM clean GROUP BY order_date""",
    "dimension_change": f"WITH {ORDERS}, {_moved('people', 3)}"
    + _mart(
        "(SELECT priced.*, country FROM priced LEFT JOIN people USING (customer_id))",
        "order_date, country", "revenue", "order_id", "customer_id", "quantity", "customers",
    ),
    "dimension_runs": f"""
WITH {ORDERS}, cuts(run_seq, low, high) AS (VALUES
  (1, TIMESTAMP '0001-01-01', TIMESTAMP '{EVENT_CUTS[0]}'), (2, TIMESTAMP '{EVENT_CUTS[0]}', TIMESTAMP '{EVENT_CUTS[1]}'),
  (3, TIMESTAMP '{EVENT_CUTS[1]}', TIMESTAMP '9999-01-01'))
SELECT CAST(run_seq AS BIGINT) AS run_seq, 'success' AS status, count(DISTINCT valid.order_id) AS rows_in_batch,
       CAST(max(raw.order_ts) AS VARCHAR) AS watermark_after
FROM cuts JOIN raw ON raw.order_ts > low AND raw.order_ts <= high
LEFT JOIN valid ON valid.order_id = raw.order_id AND valid.order_ts > low AND valid.order_ts <= high
GROUP BY run_seq
UNION ALL
SELECT 4, 'dimension_changed', 0, CAST(max(order_ts) AS VARCHAR) FROM raw""",
    "changed_days": f"""
WITH {ORDERS}, {_moved('earlier', 1)}, {_moved('later', 2)}
SELECT DISTINCT order_date FROM valid WHERE customer_id IN (
  SELECT customer_id FROM (SELECT * FROM earlier EXCEPT SELECT * FROM later)
  UNION SELECT customer_id FROM (SELECT * FROM later EXCEPT SELECT * FROM earlier))""",
    "delta_mart": f"WITH {LINES} {MONTHLY}",
    "replayed_rejects": f"WITH {ORDERS} {DAILY}",
    "resumed_load": f"WITH {LINES} {MONTHLY}",
    "load_slices": f"""
WITH {ORDERS}, days AS (SELECT order_date, count(*) AS n FROM parsed GROUP BY order_date),
starts AS (SELECT order_date, coalesce(sum(n) OVER (ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM days),
numbered AS (
  SELECT order_date, dense_rank() OVER (ORDER BY earlier // greatest(1, (SELECT count(*) FROM raw) // 5)) AS batch_id
  FROM starts),
kept AS (
  SELECT batch_id, count(DISTINCT order_id) AS rows_in_batch FROM valid JOIN numbered USING (order_date) GROUP BY batch_id),
slices AS (
  SELECT batch_id, count(*) AS rows_read, count_if(valid.order_id IS NULL) AS rows_rejected, max(parsed.order_ts) AS newest
  FROM parsed JOIN numbered USING (order_date) LEFT JOIN (SELECT DISTINCT order_id, order_ts FROM valid) AS valid
    ON valid.order_id = parsed.order_id AND valid.order_ts = parsed.order_ts
  GROUP BY batch_id),
both_kinds AS (
  SELECT 'staged' AS status, batch_id, rows_read, rows_rejected, rows_in_batch, newest FROM slices JOIN kept USING (batch_id)
  UNION ALL
  SELECT 'success', max(batch_id), sum(rows_read), sum(rows_rejected), sum(rows_in_batch), max(newest)
  FROM slices JOIN kept USING (batch_id))
SELECT status, CAST(batch_id AS BIGINT) AS batch_id, CAST(rows_read AS BIGINT) AS rows_read,
       CAST(rows_rejected AS BIGINT) AS rows_rejected, CAST(rows_in_batch AS BIGINT) AS rows_in_batch,
       CAST(newest AS VARCHAR) AS watermark_after, (SELECT count(*) FROM slices) AS slices
FROM both_kinds""",
}
EXPECTED["indexed_days"] = EXPECTED["affected_days"]
