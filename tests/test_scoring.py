"""Score goldens: every cap, floor and multiplier, worked by hand."""

import math

import pytest

from sightline.catalog.data import observations, records, tag_dimension
from sightline.functions.columns import severity
from sightline.operators import scoring as sc
from sightline.plans.scoring import score_job
from pyspark.sql import functions as F

BASE = dict(
    indicator="x", indicator_type="Address", partners=[], sources=["a"], threat_actor=None, incident=None,
    vt_count=None, obs_days=0, rating=0.0, confidence=0.0, cal_score=0.0, external_score=0.0, false_positives=0,
    tag_names=[], enrich_tags=[], botnet_tags=[], firstseen_date=None, mass_scanner=False,
)
SCHEMA = (
    "indicator string, indicator_type string, partners array<string>, sources array<string>, threat_actor string, "
    "incident string, vt_count long, obs_days long, rating double, confidence double, cal_score double, "
    "external_score double, false_positives long, tag_names array<string>, enrich_tags array<string>, "
    "botnet_tags array<string>, firstseen_date date, mass_scanner boolean"
)
CAP = (40**0.75 * 7.5 + 2.7 + 0.05 + 0.25 + 18 + 8 + math.log(8) * 2.8 + math.log(10) * 2.1 + 10 + 2.75 + 0.75 + 2 + 25)


def scored(spark, as_of="2024-01-30", **changes):
    data = BASE | changes
    df = spark.createDataFrame([tuple(data[c.split()[0]] for c in SCHEMA.split(", "))], SCHEMA)
    out = sc.score_rule(sc.score_components(df, as_of))
    return sc.score_explanation(out, as_of).first()


def expected(raw, factor=1.0, cap=CAP):
    return round(min(1000 * min(max(raw * factor / cap, 0), 1) * 1.4, 1000))


def test_cap():
    assert sc.VERSIONS[4].cap() == pytest.approx(CAP)


@pytest.mark.parametrize("changes, raw, factor, limit", [
    (dict(vt_count=8), 8**0.75 * 7.5 + 0.9, 1, None),
    (dict(vt_count=3), 3**0.75 * 7.5 + 0.9, 1, ("max", 199)),
    (dict(vt_count=13), 13**0.75 * 7.5 + 0.9, 1, ("min", 499)),
    (dict(vt_count=30, botnet_tags=["DDoS"]), 30**0.75 * 7.5 + 0.9, 0.4, ("max", 199)),
    # the VT floor lifts the penalised score to 499 before the mass-scanner cap applies
    (dict(vt_count=30, mass_scanner=True), 30**0.75 * 7.5 + 0.9, 0.05, ("both", 499, 199)),
    (dict(vt_count=9, mass_scanner=True), 9**0.75 * 7.5 + 0.9, 0.05, None),
    (dict(vt_count=9, false_positives=2), 9**0.75 * 7.5 + 0.9, 0.9, None),
    (dict(vt_count=9, tag_names=["Masscan"]), 9**0.75 * 7.5 + 0.9, 0.95, None),
    (dict(vt_count=9, obs_days=365), 9**0.75 * 7.5 + 0.9, 0.98, None),
    (dict(vt_count=9, rating=None), 9**0.75 * 7.5 + 0.9, 0.85, None),
    (dict(vt_count=8, tag_names=["tor"]), 8**0.75 * 7.5 + 0.9 + 9, 1, None),
    (dict(vt_count=10, tag_names=["TOR exit"]), 10**0.75 * 7.5 + 0.9 + 18, 1, None),
    (dict(vt_count=8, tag_names=["monitor"]), 8**0.75 * 7.5 + 0.9, 1, None),
    (dict(vt_count=8, threat_actor="APT", incident="INC1"), 8**0.75 * 7.5 + 0.9 + 10 + 8 + 7, 1, None),
    (dict(vt_count=8, threat_actor="APT", incident="INC1", sources=["a", "b"], partners=["p", "q"]),
     8**0.75 * 7.5 + 0.9 + 10 + 8 + 25 + math.log(2) * 4.9, 1, None),
])
def test_score_goldens(spark, changes, raw, factor, limit):
    want = expected(raw, factor)
    if limit and limit[0] != "max":
        want = max(want, limit[1])
    if limit and limit[0] != "min":
        want = min(want, limit[-1])
    assert scored(spark, **changes).score == want


def test_file_is_critical(spark):
    row = scored(spark, indicator_type="SHA256", vt_count=1, mass_scanner=True, botnet_tags=["spam"])
    assert row.severity == "critical" and row.score >= 800


def test_tor_boost_lifts_the_botnet_cap(spark):
    row = scored(spark, vt_count=20, tag_names=["tor"], botnet_tags=["ddos"])
    assert row.score == 499  # the VT floor, not the botnet cap


@pytest.mark.parametrize("score, want", [
    (0, "low"), (199, "low"), (200, "medium"), (499, "medium"), (500, "high"), (799, "high"),
    (800, "critical"), (1000, "critical"),
])
def test_severity_edges(spark, score, want):
    assert spark.range(1).select(severity(F.lit(score))).first()[0] == want


def test_explanation(spark):
    row = scored(spark, vt_count=8, threat_actor="APT9", sources=["b", "a"], firstseen_date=None)
    assert row.explanation == (
        f"[2024-01-30] Severity: {row.severity}. VT score: 8. Contextual Drivers: VT malicious (log-scaled); "
        "Associated with APT9; Reinforcing context bonus. No partner attribution. Observed by 2 sources: b, a. "
        "2 reinforcing context signal(s). No botnet penalty. No false positive tags. No scanner penalty. "
        f"No TOR activity. No incident/event link. Associated threat actor(s): APT9. Score: {row.score}/1000."
    )


def test_recurrence_risk_scale(spark):
    df = spark.createDataFrame([(500, 0.25, 25.0)], "score int, probability_7 double, pct double")
    assert sc.recurrence_risk(df, (7,)).first().risk_7d == 125.0
    as_percent = df.withColumn("probability_7", F.col("pct"))
    assert sc.recurrence_risk(as_percent, (7,), "percent").first().risk_7d == 125.0


def test_score_decay(spark):
    rows = [("a", "Address", 500, "2023-11-20"), ("b", "MD5", 5, "2023-01-01"), ("c", "Host", 100, "2024-01-29")]
    df = spark.createDataFrame(rows, "indicator string, indicator_type string, score int, last_observed string")
    got = {r.indicator: r.decayed_score for r in sc.score_decay(df, "2024-01-30").collect()}
    assert got == {"a": 420, "b": 0, "c": 100}


def test_score_job_is_one_lazy_plan(spark):
    """Building the job starts no Spark job, so the records are not read once more before the plan runs."""
    sf = "/root/testdata/sf0.001"
    recs, obs, tags = records(spark, sf), observations(spark, sf), tag_dimension(spark, sf)
    spark.sparkContext.setJobGroup("score_job_build", "building")
    try:
        out = score_job(recs, obs, tags, "2024-01-30", min_total=1200, min_partners=5)
        started = spark.sparkContext.statusTracker().getJobIdsForGroup("score_job_build")
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)
    assert list(started) == [] and "enrich_tags" in out.columns
