"""Every registered query against its SQL twin at the smallest scale."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from sightline.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# model fits are slow and have their own property tests
FITTED = {
    "fit_logistic", "fit_boosted", "fit_survival", "forecast_job", "two_stage_forecast", "score_learned",
    "ar_forecast_by_series", "feature_importance", "cluster_indicators", "cluster_profiles",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == FITTED
    assert set(queries()) >= set(QUERIES) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    problem = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert problem is None, problem
