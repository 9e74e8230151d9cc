"""Plan checks: no cross product, no row-at-a-time Python, one exchange for the window block."""

import re

import pytest
from pyspark.sql import functions as F

from sightline.catalog import QUERIES
from sightline.catalog.data import observations, table
from sightline.operators import evaluation as ev
from sightline.operators import joins
from sightline.operators import timeseries as ts

SF = "/root/testdata/sf0.001"
SKIP = re.compile(r"^(stream_|fit_|forecast_job|two_stage|score_learned|ar_forecast|feature_imp|cluster_)")
NAMES = sorted(n for n in QUERIES if not SKIP.match(n))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_product_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_window_block_shares_one_exchange(spark):
    panel = ts.dense_panel(observations(spark, SF), "2024-01-30")
    base = plan(panel).count("Exchange hashpartitioning")
    assert plan(ts.temporal_features(panel)).count("Exchange hashpartitioning") == base
    assert plan(ts.recurrence_features(panel)).count("Exchange hashpartitioning") == base


def test_scan_is_pruned_and_filtered(spark):
    obs = observations(spark, SF).where("obs_date >= '2024-01-20'")
    text = plan(obs.select("indicator", "observations"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "props" not in schema and "event_type" not in schema


@pytest.fixture()
def large_tables(spark):
    """Plan as if no table were small enough to be broadcast unasked."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["dense_panel", "cross_panel", "class_weights", "merge_incremental", "resolve_outcomes"])
def test_no_exchange_of_facts_on_a_few_values(spark, large_tables, name):
    text = plan(QUERIES[name](spark, SF))
    alone = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, \d+\)", text)
    assert not {"OpDiv", "label", "obs_date", "_label", "quality"} & set(alone), alone


def test_phrase_join_explodes_narrow_rows(spark, large_tables):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    phrases = table(spark, SF, "benchmark").select("item_id", F.col("text").alias("phrase"))
    text = plan(joins.keyphrase_join(docs, phrases))
    for generate in re.findall(r"Generate explode.*", text):
        assert not re.search(r"\btext#\d+", generate.split("],", 1)[-1].split("false")[0].split("[", 1)[-1]), generate


def test_class_weights_of_null_labels(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "y string")
    assert sorted((r.y, r.weight) for r in ev.class_weights(rows, "y").collect()) == [("a", 0.75), ("a", 0.75), ("b", 1.5)]
