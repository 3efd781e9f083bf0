"""Every registered query against its oracle SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from compare import difference, oracle_connection
from conftest import MEDIUM, SMALL

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(MEDIUM)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, MEDIUM), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 150 and len(df.columns) == 16


def test_permutation_importance_is_of_all_features(spark):
    assert QUERIES["permutation_importance"](spark, SMALL).count() > 50
