"""Order-insensitive comparison of a Spark result with DuckDB's over the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


SAME_TYPE = {
    "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE", "double": "DOUBLE", "int": "INTEGER",
    "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def differences(frame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty where columns, types and the bag of rows agree exactly."""
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} vs {sorted(names)}"]
    order = sorted(names)
    theirs = Counter(
        tuple(_plain(row[names.index(n)]) for n in order) for row in expected.fetchall()
    )
    ours = Counter(tuple(_plain(row[n]) for n in order) for row in frame.collect())
    found = []
    if ours != theirs:
        found.append(
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; "
            f"only Spark {list((ours - theirs).items())[:3]}; "
            f"only SQL {list((theirs - ours).items())[:3]}"
        )
    types = dict(row[:2] for row in db.execute(f"DESCRIBE {sql}").fetchall())
    wrong = {c: (t, types[c]) for c, t in frame.dtypes if SAME_TYPE.get(t) != types[c]}
    if wrong:
        found.append(f"types {wrong}")
    return found
