"""Every registered query against its independent DuckDB statement (sf0.01)."""

import pytest

import __spark_entry__ as entry
from pitchside.oracle import ORACLE_SQL
from pitchside.registry import QUERIES
from tests.compare import compare, duck

from .conftest import SF001

ORACLE = ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF001), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["team", "attack"]
    assert df.count() > 0
