"""Registered queries against their SQL, and the contracts that SQL cannot express."""

import pytest
from compare import connect, differences
from corpus_tables import MEDIUM, rows

from __spark_entry__ import oracle_sql, queries
from martflow.llm.queries import EXPECTED, QUERIES


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, MEDIUM), connect(MEDIUM), EXPECTED[name]) == []


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(EXPECTED) <= set(oracle_sql())


@pytest.mark.parametrize("number", [2, 3, 5, 8, 10, 13])
def test_one_row_for_each_document(spark, number):
    (name,) = [n for n in QUERIES if n.startswith(f"op{number}_")]
    found = sorted(r["doc_id"] for r in QUERIES[name](spark, MEDIUM).select("doc_id").collect())
    assert found == [r[0] for r in rows(MEDIUM, "SELECT doc_id FROM documents ORDER BY 1")]
