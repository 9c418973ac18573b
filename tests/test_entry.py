"""Every registered query against DuckDB over the same tables."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect
from helpers import SF

import __spark_entry__ as entry
from tarmac.workload import oracle, queries as registered

QUERIES = registered.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) == 102
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_training_data_part(monkeypatch):
    monkeypatch.setattr(entry, "_llm", lambda: None)
    assert set(entry.queries()) == set(QUERIES)
    assert set(entry.oracle_sql()) == set(ORACLES)


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 22
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF), connection, ORACLES[name]) is None
