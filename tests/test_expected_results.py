"""Every registered query against its SQL, over the whole tables."""

import pytest

from __spark_entry__ import entry
from compare import connect, differences
from workloads.expected_sql import EXPECTED
from workloads.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_each_query_has_expected_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, FOLDER), db, EXPECTED[name]) == []


def test_entry_returns_the_mart(spark):
    mart = entry(spark)
    assert mart.columns == [
        "order_date", "category", "total_revenue", "orders", "customers", "units",
        "avg_order_value",
    ]
    assert mart.count() > 0
