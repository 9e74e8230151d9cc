"""Hand-worked series and properties of panels and features."""

import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sightline.operators import forecast as fc
from sightline.operators import timeseries as ts

START = date(2024, 1, 1)
SERIES = [0, 1, 0, 0, 1, 1, 0, 0, 0, 1, 0, 0]


def panel_of(spark, series, key="a"):
    data = [("P", key, START + timedelta(n), s * 5, s) for n, s in enumerate(series)]
    return spark.createDataFrame(data, "OpDiv string, indicator string, date date, observations long, seen int")


def obs_of(spark, data):
    return spark.createDataFrame(data, "OpDiv string, indicator string, obs_date date, observations long")


def test_recurrence_features_golden(spark):
    row = ts.recurrence_features(panel_of(spark, SERIES)).first()
    assert (row.last_seen, row.freq_1, row.freq_7, row.freq_14, row.label_7) == (2, 0, 2, 4, 1)
    assert row.avg_gap == pytest.approx(8 / 3)
    sigma = math.sqrt(14 / 9)
    assert row.burstiness == pytest.approx((sigma - 8 / 3) / (sigma + 8 / 3))


def test_recurrence_features_never_seen(spark):
    row = ts.recurrence_features(panel_of(spark, [0] * 12)).first()
    assert (row.last_seen, row.avg_gap, row.burstiness, row.freq_30, row.label_45) == (12, 12.0, 0.0, 0, 0)


def test_label_window_covers_all_days(spark):
    series = [0] * 20 + [1] + [0] * 29  # seen 30 days ago: inside 45 days, outside 14
    row = ts.recurrence_features(panel_of(spark, series)).first()
    assert (row.label_45, row.label_14) == (1, 0)


def test_dense_panel_rows_and_filter(spark):
    obs = obs_of(spark, [
        ("P", "a", date(2024, 1, 2), 3), ("P", "a", date(2024, 1, 2), 4), ("P", "a", date(2024, 1, 5), 1),
        ("P", "b", date(2024, 1, 1), 9), ("Q", "a", date(2024, 1, 4), 1), ("P", "z", date(2024, 1, 1), 0),
        ("P", "z", date(2024, 1, 3), 0),
    ])
    out = ts.dense_panel(obs, "2024-01-06").orderBy("date").collect()
    assert {(r.OpDiv, r.indicator) for r in out} == {("P", "a")}
    assert [r.observations for r in out] == [0, 7, 0, 0, 1, 0]
    assert [r.seen for r in out] == [0, 1, 0, 0, 1, 0]
    assert {r.total_seen for r in out} == {2}


def test_hot_indicator_is_one_row_per_day(spark):
    many = spark.range(20_000).select(
        F.lit("P").alias("OpDiv"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("indicator"),
        F.date_add(F.lit(START), (F.col("id") % 4).cast("int")).alias("obs_date"), F.lit(1).cast("long").alias("observations"),
    )
    out = ts.dense_panel(many, "2024-01-04").where("indicator = 'hot'").collect()
    assert len(out) == 4 and sum(r.observations for r in out) == 6667


def test_streaks(spark):
    p = panel_of(spark, SERIES)
    got = [r.seen_streak for r in ts.seen_streak(p).orderBy("date").collect()]
    assert got == [0, 1, 0, 0, 1, 2, 0, 0, 0, 1, 0, 0]
    row = ts.streak_summary(p).first()
    assert (row.max_seen_streak, row.max_unseen_streak, row.days_since_last_seen) == (2, 3, 2)


def test_days_since_last_seen(spark):
    p = panel_of(spark, SERIES)
    loose = [r.days_since_last_seen for r in ts.days_since_last_seen(p).orderBy("date").collect()]
    strict = [r.days_since_last_seen for r in ts.days_since_last_seen(p, True).orderBy("date").collect()]
    assert loose == [None, 0, 1, 2, 0, 0, 1, 2, 3, 0, 1, 2]
    assert strict == [0, 0, 1, 2, 3, 1, 1, 2, 3, 4, 1, 2]


def test_ewm_is_the_recursion(spark):
    got = [r.observations_ewm_3 for r in ts.ewm(panel_of(spark, SERIES), "observations", 3).orderBy("date").collect()]
    want = [float(SERIES[0] * 5)]
    for s in SERIES[1:]:
        want.append(want[-1] + 0.5 * (s * 5 - want[-1]))
    assert got == pytest.approx(want)


def test_minmax_zero_range(spark):
    out = ts.minmax_scale(panel_of(spark, [1, 1, 1]), "observations").collect()
    assert {r.observations_scaled for r in out} == {0.0}


@pytest.mark.parametrize("values, bands", [
    ([0, 0, 0, 0, 5, 7, 8, 9, 9, 10], {0: "Low", 10: "Critical"}),
    ([0, 0, 0, 0, 0, 0, 0, 0, 0, 10], {0: "High", 10: "Critical"}),  # lower edges collapse
])
def test_quantile_bands(spark, values, bands):
    df = spark.createDataFrame([(str(i), float(v)) for i, v in enumerate(values)], "indicator string, v double")
    got = {r.v: r.band for r in ts.quantile_bands(df, "v").collect()}
    assert all(got[v] == b for v, b in bands.items())


def test_top_fraction_with_ties(spark):
    df = spark.createDataFrame([(f"{i:03d}", 7 if i % 3 else 9) for i in range(90)], "indicator string, score int")
    got = sorted(r.indicator for r in ts.top_fraction(df, "score", 0.4).collect())
    want = sorted(sorted(((-(7 if i % 3 else 9)), f"{i:03d}") for i in range(90))[n][1] for n in range(36))
    assert got == want


def test_feature_properties(spark):
    obs = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_type").alias("OpDiv"), F.col("user_id").cast("string").alias("indicator"),
        F.to_date("ts").alias("obs_date"), F.ceil("value").cast("long").alias("observations"),
    )
    panel = ts.dense_panel(obs, "2024-01-30")
    features = fc.exp_hazard(ts.recurrence_features(panel))
    wrong = features.where(
        "freq_7 > freq_14 OR freq_14 > freq_30 OR exp_1 > exp_7 OR exp_7 > exp_30 OR exp_30 > 1 OR exp_1 < 0"
    )
    assert wrong.count() == 0
    sizes = panel.groupBy("OpDiv", "indicator").agg(F.count("*").alias("n"), F.countDistinct("date").alias("d"))
    assert sizes.where("n <> d").count() == 0


def test_exp_hazard_golden(spark):
    df = spark.createDataFrame([(15,), (None,)], "freq_30 int")
    got = [r.exp_7 for r in fc.exp_hazard(df, (7,)).collect()]
    assert got[0] == pytest.approx(1 - math.exp(-3.5))
    assert got[1] == pytest.approx(7e-6, rel=1e-3)


@pytest.mark.parametrize("p, f, want", [
    (0.60, 2, "Highly likely"), (0.60, 1, "Possibly active"), (0.07, 1, "Possibly active"),
    (0.07, 0, "Low confidence"), (None, 5, "Low confidence"),
])
def test_confidence(spark, p, f, want):
    df = spark.createDataFrame([(p, f)], "ensemble_7 double, freq_7 int")
    assert fc.confidence_band(df, 7).first().confidence_7 == f"7-Day: {want}"


def test_version_one_weights_sum():
    assert sum(fc.WEIGHTS.values()) == pytest.approx(1.0)
    assert sum(fc.WEIGHTS_V1.values()) == pytest.approx(1.1)


def test_resolve_outcomes(spark):
    day = date(2024, 2, 1)
    log = spark.createDataFrame(
        [("P", " Ind ", "7-Day: Highly likely", day, "Pending"), ("P", "b", "Low", day, "Pending"),
         ("P", "c", "Low", date(2024, 3, 1), "Pending")],
        ["Partner", "Indicator", "Confidence", "Forecasted Check Date", "Outcome"],
    )
    reports = spark.createDataFrame(
        [("p", "ind", day, 1), ("p", "ind", day, 0), ("Q", "b", day, 1)],
        ["Partner", "Indicator", "FileDate", "Observed Today"],
    )
    got = {r.Indicator.strip(): (r.Outcome, r.Confidence) for r in fc.resolve_outcomes(log, reports).collect()}
    assert got == {"Ind": ("Seen", "Highly likely"), "b": ("Not Seen", "Low"), "c": ("Pending", "Low")}
