"""Every registered query against its SQL, or against being non-empty."""

from __future__ import annotations

import pytest
from oracle import compare, connect

from fareway.registry.oracles import all_oracles
from fareway.registry.queries import all_queries

QUERIES, SQL = all_queries(), all_oracles()
NOT_SQL = {"svm_decisions", "demand_model_metrics", "demand_predictions"}


def test_every_query_has_sql_unless_it_trains_a_model():
    assert set(QUERIES) - set(SQL) == NOT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(NOT_SQL - {"demand_model_metrics"}))
def test_query_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_demand_models_are_compared(spark, sf_dir):
    models = {r.model for r in QUERIES["demand_model_metrics"](spark, sf_dir).collect()}
    assert models == {"baseline_mean", "linear_regression_baseline", "random_forest_regressor"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "pickup_hour"
    assert set(QUERIES) <= set(entry.queries())
