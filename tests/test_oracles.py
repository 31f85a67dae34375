"""Every query with an oracle returns the oracle's rows."""

import pytest
from oracle import connect, difference, duck_rows, spark_rows

import __spark_entry__ as contract
from hazeframe.registry.oracles import ORACLES
from hazeframe.registry.queries import QUERIES

TRAINED = {
    "ridge_metrics", "forest_metrics", "boosting_metrics", "network_metrics",
    "model_metrics", "best_models", "model_predictions", "model_sensor_mae",
}


@pytest.fixture(scope="module")
def duck(medium):
    return connect(medium)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == TRAINED


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, medium, duck, name):
    rows = spark_rows(QUERIES[name](spark, medium))
    assert rows[1], "a query without rows checks nothing"
    assert difference(rows, duck_rows(duck, ORACLES[name])) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
