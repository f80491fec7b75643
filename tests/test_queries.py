"""Every registered query against its SQL on the smallest data."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
QUERIES, ORACLE, LLM = entry.queries(), entry.oracle_sql(), entry.LLM_QUERIES
SLOW = {"train_best"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert "train_best" in set(QUERIES) - set(ORACLE)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE and n not in LLM])
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
