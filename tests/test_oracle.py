"""Every query with oracle SQL gives the rows the SQL gives."""

import pytest
from conftest import SMALL
from oracle_check import connect, difference

import __spark_entry__ as entry_points

ORACLE = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.count() == 18
    assert {"auc", "ece", "log_loss"} <= set(df.columns)
