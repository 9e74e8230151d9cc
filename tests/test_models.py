"""Model properties: separable data, known scales, single classes, leaks."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import evaluation as ev
from sightline.operators import models as md
from sightline.operators import runs as rl
from sightline.operators.models import _fit_ar
from sightline.plans import forecast as plan
from sightline.plans.forecast import training_frame


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    data = [(i, float(a), float(b) if i % 17 else None, int(a + b > 0)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(data, "id int, a double, b double, y int")


@pytest.mark.parametrize("fit", [md.fit_logistic, md.fit_boosted])
def test_classifiers_separate(spark, separable, fit):
    out = fit(separable, ("a", "b"), "y", out="p")
    assert out.columns == [*separable.columns, "p"]
    assert out.where("p < 0 OR p > 1 OR p IS NULL").count() == 0
    assert ev.probability_metrics(out, "y", "p").first().auc > 0.95


@pytest.mark.parametrize("fit", [md.fit_logistic, md.fit_boosted])
def test_single_class_gives_null(spark, separable, fit):
    one = separable.withColumn("y", F.lit(1))
    assert fit(one, ("a", "b"), "y", out="p").where("p IS NOT NULL").count() == 0


def test_survival_recovers_the_scale(spark):
    rng = np.random.default_rng(5)
    times = 40.0 * rng.weibull(2.0, 600)
    df = spark.createDataFrame([(float(t), 1, float(i % 2)) for i, t in enumerate(times)], "t double, e int, x double")
    out = md.fit_survival(df, ("x",), "t", "e", (10, 40, 80)).first()
    assert out.weibull_40 == pytest.approx(1 - np.exp(-1), abs=0.06)
    assert out.weibull_10 < out.weibull_40 < out.weibull_80
    few = md.fit_survival(df.limit(3), ("x",), "t", "e", (10,))
    assert few.where("weibull_10 IS NOT NULL").count() == 0


def test_training_labels_lie_after_the_features(spark):
    start = date(2024, 1, 1)
    days = {"early": [0, 2, 4], "late": [0, 2, 18]}
    data = [("P", k, start + timedelta(d), 1) for k, ds in days.items() for d in ds]
    obs = spark.createDataFrame(data, "OpDiv string, indicator string, obs_date date, observations long")
    got = {r.indicator: (r.label, r.freq_30) for r in training_frame(obs, "2024-01-20", 7).collect()}
    assert got == {"early": (0, 3), "late": (1, 2)}  # the late sighting is no feature


def test_ar_fits_a_known_process():
    x = [1.0, 0.5]
    for _ in range(60):
        x.append(0.5 * x[-1] + 0.3 * x[-2] + 1.0)
    rng = np.random.default_rng(0)
    p, beta, sigma, _aic = _fit_ar(np.array(x) + rng.normal(scale=1e-4, size=len(x)), 5)
    assert p >= 1 and sigma < 1e-2
    assert _fit_ar(np.array([1.0, 2.0]), 5) is None


def test_ar_forecast_shape(spark):
    start = date(2024, 1, 1)
    data = [("P", k, start + timedelta(d), int(d % 7 + 3)) for k in ("a", "b") for d in range(60)]
    panel = spark.createDataFrame(data, "OpDiv string, indicator string, date date, observations long")
    out = md.ar_forecast_by_series(panel, "observations", 7, 7).orderBy("indicator", "date").collect()
    assert len(out) == 14 and str(out[0].date) == "2024-03-01"
    assert [round(r.forecast) for r in out[:7]] == [(60 + d) % 7 + 3 for d in range(7)]
    assert all(r.lower <= r.forecast <= r.upper for r in out)


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(9)
    p, y = rng.random(400).round(2), rng.integers(0, 2, 400)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int")
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    row = ev.probability_metrics(df, "y", "p").first()
    assert row.auc == pytest.approx(auc) and row.brier == pytest.approx(np.mean((p - y) ** 2))


def test_mape_leaves_out_zeros(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    assert ev.forecast_metrics(df, "y", "p").first().mape == 50.0


def test_clusters_find_the_outlier(spark):
    data = [(i, float(i % 2) * 10 + i * 0.001) for i in range(99)] + [(99, 60.0)]
    out, silhouette = md.cluster_indicators(spark.createDataFrame(data, "id int, v double"), ("v",), 2, 0.01)
    assert silhouette > 0.5
    assert out.where("is_outlier").count() == 1 and out.where("cluster = -1").count() == 1


def test_learned_score_explains_a_rule_that_its_inputs_hold(spark):
    """R² of at least 0.90 on keys that the fit has not seen, where the score follows from the inputs."""
    rng = np.random.default_rng(4)
    names = [c for c in md.SCORE_FEATURES if c != "botnet_flag"]
    data = []
    for i in range(1_200):
        values = rng.integers(0, 20, len(names)).astype(float).tolist()
        score = int(min(1000, 30 * values[0] + 12 * values[2] + (150 if values[6] > 9 else 0)))
        data.append((f"k{i}", score, i % 50 == 0, False, *values))
    schema = "indicator string, score int, is_file boolean, has_botnet boolean, " + ", ".join(f"{c} double" for c in names)
    out, metrics = md.score_learned(spark.createDataFrame(data, schema), rounds=80)
    row = metrics.first()
    assert row.n > 150 and row.r2 >= 0.90
    rows = out.collect()
    assert all(r.final_score == r.score for r in rows if r.is_file)
    assert all(r.final_score == round(0.7 * r.score + 0.3 * r.learned_score) or abs((0.7 * r.score + 0.3 * r.learned_score) % 1 - 0.5) < 1e-9 for r in rows if not r.is_file)


def test_ar_forecast_fits_series_together(spark):
    """Series of several lengths in one frame equal a plain least-squares fit of each alone, constant ones too."""
    rng, start, max_p, data = np.random.default_rng(5), date(2024, 1, 1), 3, {}
    for k in range(24):
        n = (1, 4, 12, 30)[k % 4]
        data[f"s{k}"] = [0.0] * n if k < 4 else [float(v) for v in rng.integers(0, 9, n)]
    rows = [("P", k, start + timedelta(d), v) for k, x in data.items() for d, v in enumerate(x)]
    panel = spark.createDataFrame(rows, "OpDiv string, indicator string, date date, observations double")
    out = md.ar_forecast_by_series(panel.repartition(3), "observations", max_p, 1)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()  # no group function per series
    got = {r.indicator: r for r in out.collect()}
    assert len(got) == len(data)
    for k, x in data.items():
        x, best, top = np.array(x), None, min(max_p, (len(data[k]) - 2) // 3)
        for p in range(1, top + 1):
            design = np.column_stack([np.ones(len(x) - top)] + [x[top - j : len(x) - j] for j in range(1, p + 1)])
            beta = np.linalg.lstsq(design, x[top:], rcond=None)[0]
            sse = ((x[top:] - design @ beta) ** 2).sum()
            aic = len(design) * np.log(max(sse / len(design), 1e-12)) + 2 * (p + 2)
            if best is None or aic < best[0] - 1e-9:
                best = aic, p, beta[0] + beta[1:] @ x[::-1][:p]
        order, want = (best[1], best[2]) if best else (0, x.mean())
        assert got[k].order == order and got[k].forecast == pytest.approx(want, abs=1e-8)
        assert got[k].date == start + timedelta(len(x))


def test_boosted_fit_reads_its_rows_once_and_weighs_equal_ones(spark, separable):
    """The plan of the training rows runs once, whatever the rounds, and copies of all rows change nothing."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    train = separable.mapInPandas(counted, separable.schema)
    once = md.fit_boosted(train, ("a", "b"), "y", rounds=3, out="p", apply_to=separable).select("id", "p").collect()
    assert read.value == 300
    copies = separable.unionByName(separable).unionByName(separable)
    thrice = md.fit_boosted(copies, ("a", "b"), "y", rounds=3, out="p", apply_to=separable).select("id", "p").collect()
    assert {r.id: r.p for r in thrice} == pytest.approx({r.id: r.p for r in once}, abs=1e-12)


def test_medians_count_weights(spark):
    rows = [(1.0, 5.0, 3.0), (2.0, None, 1.0), (9.0, 7.0, 1.0), (4.0, float("nan"), 8.0)]
    assert md._medians(spark.createDataFrame(rows, "a double, b double, _weight double"), ["a", "b"]) == {"a": 4.0, "b": 5.0}
    with pytest.raises(ValueError, match="no value to impute: b"):
        md._medians(spark.createDataFrame([(1.0, None, 2.0)], "a double, b double, _weight double"), ["a", "b"])


def test_learned_score_fits_equal_parts_one_a_core(spark, monkeypatch):
    """However many parts the scores come in, the passes of the fit start no more tasks than there are cores."""
    rng, seen = np.random.default_rng(6), []
    names = [c for c in md.SCORE_FEATURES if c != "botnet_flag"]
    data = [(f"k{i}", int(v[0] * 30), False, False, *v) for i, v in enumerate(rng.integers(0, 20, (1_000, len(names))).astype(float).tolist())]
    schema = "indicator string, score int, is_file boolean, has_botnet boolean, " + ", ".join(f"{c} double" for c in names)
    fit = md.Pipeline.fit

    def watched(self, rows, *more):
        seen.extend(rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
        return fit(self, rows, *more)

    monkeypatch.setattr(md, "TASK_ROWS", 10)
    monkeypatch.setattr(md.Pipeline, "fit", watched)
    out, _metrics = md.score_learned(spark.createDataFrame(data, schema).repartition(40), rounds=1)
    assert out.count() == 1_000
    cores = spark.sparkContext.defaultParallelism
    assert len(seen) == cores and max(seen) < 2 * sum(seen) / cores


@pytest.mark.parametrize("mode", ["out_of_sample", "in_sample"])
def test_forecast_job_takes_all_training_days_from_one_pass(spark, monkeypatch, mode):
    """The sightings are put in order once, whatever the horizons, and each fit gets the rows of its own training frame."""
    rng, as_of, horizons = np.random.default_rng(8), "2024-03-01", (1, 7, 30)
    data = [
        (("P", "Q")[v % 2], None if v % 25 == 0 else f"k{v % 25}", date(2024, 1, 1) + timedelta(int(d)), int(o))
        for v, d, o in zip(rng.integers(0, 50, 400), rng.integers(0, 66, 400), rng.integers(-1, 4, 400))
    ]
    obs = spark.createDataFrame(data, "OpDiv string, indicator string, obs_date date, observations long")
    days = obs.groupBy("OpDiv", "indicator", "obs_date").agg(F.sum("observations").alias("observations"))
    sort = lambda found: sorted(tuple(round(float(v), 10) for v in r) for r in found)
    panel = rl.run_length_panel(obs, as_of)
    now, today = rl.recurrence_features(panel, as_of), rl.seen_on(panel, as_of)
    frames = {
        h: now.withColumn("label", F.col(f"label_{max(h, 7)}")) if mode == "in_sample" else training_frame(days, as_of, h) for h in horizons
    }
    want = {h: sort(frame.select(*md.FEATURES, "label").collect()) for h, frame in frames.items()}
    got, panels, run_length_panel = {}, [], plan.run_length_panel

    def model(train, label="label", out="weibull", event="label", times=()):
        names = [f"{out}_{t}" for t in times] or [out]
        got[names[0]] = sort(train.select(*md.FEATURES, label).collect())
        return lambda target: target.withColumns({c: F.lit(0.5) for c in names})

    for name in ("logistic_scorer", "boosted_scorer", "survival_scorer"):
        monkeypatch.setattr(plan, name, model)
    monkeypatch.setattr(plan, "run_length_panel", lambda *a, **k: panels.append(a) or run_length_panel(*a, **k))
    report = plan.forecast_job(obs, as_of, horizons, mode).collect()
    assert len(panels) == 1
    assert got == {f"{m}_{h}": rows for h, rows in want.items() for m in ("logistic", "boosted", "weibull")}
    seen = {(r.OpDiv, r.indicator): r.seen for r in today.collect() if r.indicator}
    assert len(report) == now.count() > len(seen) > 40
    assert all(r["Observed Today"] == seen.get((r.Partner, r.Indicator)) for r in report)


def test_boosted_fit_reads_equal_parts_one_a_core(spark, separable, monkeypatch):
    """The passes of the trees start no more tasks than there are cores, however many parts the exchange of equal rows has."""
    parts, fit = [], md.Pipeline.fit
    monkeypatch.setattr(md, "TASK_ROWS", 10)
    monkeypatch.setattr(md.Pipeline, "fit", lambda self, rows, *more: parts.append(rows.rdd.getNumPartitions()) or fit(self, rows, *more))
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        md.fit_boosted(separable, ("a", "b"), "y", rounds=1)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert parts == [spark.sparkContext.defaultParallelism]
