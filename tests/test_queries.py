"""Every named query on the smallest given tables: against DuckDB where SQL can say it, else that it runs."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as contract
from salescope.operators import clustering
from salescope.plans.oracle import ORACLE
from salescope.plans.registry import QUERIES

# The few test customers of the smallest tables have too few purchases to be scored.
MAY_BE_EMPTY = {"repurchase_scores", "first_repurchase_scores", "latest_forecasts"}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.fixture(scope="module", autouse=True)
def one_space():
    """The queries on baskets all use the same table: its components are worked out once."""
    made, original = [], clustering.basket_space

    def space(df, k=3):
        if not made:
            made.append(original(df, k))
        return made[0]

    clustering.basket_space = space
    yield
    clustering.basket_space = original


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, ORACLE[name]) == ""


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries()) >= set(QUERIES) >= set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_the_rest_runs(spark, sf, name):
    frame = QUERIES[name](spark, sf)
    assert len(frame.columns) == len(set(frame.columns))
    assert frame.count() > 0 or name in MAY_BE_EMPTY


def test_entry(spark):
    rows = contract.entry(spark).collect()
    spent = [r.total_spent for r in rows]
    assert len(rows) == 20 and spent == sorted(spent, reverse=True)
