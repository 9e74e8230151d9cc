"""Queries of models and evaluation.

Fitted models have no SQL twin; their queries report rows only and the tests check properties.
Evaluation operators are plain aggregation and are compared with SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators import models as md
from ..operators import scoring as sc
from ..operators import timeseries as ts
from ..operators.density import density_clusters
from ..plans.forecast import forecast_job, training_frame
from .data import AS_OF, PARTNERS, observations, score_inputs, table, with_tables
from .q_timeseries import _F14, _FEATURES, _STREAK, PANEL, features, panel
from .registry import register
from .tidy import d, i, r, tidy


@register("training_frame", f"""{with_tables('obs')}, pst AS (SELECT OpDiv, indicator, obs_date AS date, sum(observations) AS o FROM obs WHERE obs_date <= DATE '2024-01-23' GROUP BY ALL),
  k AS (SELECT OpDiv, indicator, sum(CASE WHEN o > 0 AND date > DATE '2024-01-16' THEN 1 ELSE 0 END) AS freq_7, datediff('day', max(date) FILTER (WHERE o > 0), DATE '2024-01-23') AS last_seen FROM pst GROUP BY ALL HAVING count(*) FILTER (WHERE o > 0) >= 2),
  l AS (SELECT DISTINCT OpDiv, indicator FROM obs WHERE obs_date > DATE '2024-01-23' AND observations > 0)
  SELECT k.OpDiv, k.indicator, {i('freq_7')} AS freq_7, {i('last_seen')} AS last_seen, CAST(l.indicator IS NOT NULL AS BIGINT) AS label FROM k LEFT JOIN l ON k.OpDiv = l.OpDiv AND k.indicator = l.indicator""")
def _(spark, sf):
    return tidy(training_frame(observations(spark, sf), AS_OF, 7), "OpDiv", "indicator", "freq_7", "last_seen", "label")


for _name in ("fit_logistic", "fit_boosted"):
    def _query(spark, sf, name=_name):
        train = training_frame(observations(spark, sf), AS_OF, 7)
        out = getattr(md, name)(train, label="label", out="probability", apply_to=features(spark, sf))
        return out.select("OpDiv", "indicator", "probability")

    register(_name)(_query)


def _coins(spark, sf):
    """Orders with a two-valued feature and a label whose share differs between its values."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("id"), (F.col("o_custkey") % 2).cast("double").alias("x"),
        (key % 7 < F.when(F.col("o_custkey") % 2 == 0, 2).otherwise(4)).cast("int").alias("y"))


_COINS = """WITH c AS (SELECT o_orderkey AS id, o_custkey % 2 AS x, CASE WHEN o_orderkey % 7 < CASE WHEN o_custkey % 2 = 0 THEN 2 ELSE 4 END THEN 1 ELSE 0 END AS y FROM orders),
 g AS (SELECT x, avg(y) AS rate FROM c GROUP BY x)"""


# without a penalty, a logistic regression on one two-valued feature gives the share of each group
@register("fit_logistic_rates", f"{_COINS} SELECT id, round(rate, 2) AS probability FROM c JOIN g USING (x)")
def _(spark, sf):
    out = md.fit_logistic(_coins(spark, sf), ("x",), "y", c=1e9, out="probability")
    return out.select("id", F.round("probability", 2).alias("probability"))


# one tree of one split on labels of -1 and 1 gives the mean of each group, read as half log-odds
@register("fit_boosted_split", f"{_COINS} SELECT id, round(1 / (1 + exp(-2 * (2 * rate - 1))), 6) AS probability FROM c JOIN g USING (x)")
def _(spark, sf):
    out = md.fit_boosted(_coins(spark, sf), ("x",), "y", rounds=1, depth=1, out="probability")
    return out.select("id", F.round("probability", 6).alias("probability"))


# a feature that is the label takes all importance from one that is constant
@register("feature_importance_label", "SELECT * FROM (VALUES ('y', 1.0::DOUBLE), ('flat', 0.0::DOUBLE)) AS t(feature, importance)")
def _(spark, sf):
    rows = _coins(spark, sf).withColumn("flat", F.lit(3.0))
    return md.feature_importance(rows, ("flat", "y"), "y")


@register("fit_survival")
def _(spark, sf):
    out = md.fit_survival(features(spark, sf))
    return out.select("OpDiv", "indicator", *[f"weibull_{t}" for t in (1, 7, 14, 30, 45)])


# without a feature that varies and without censoring, the fit is that of one Weibull curve, whose
# shape solves an equation that iteration solves too
@register("fit_survival_curve", """WITH RECURSIVE x AS (SELECT (1 + o_orderkey % 30) / 100.0::DOUBLE AS d FROM orders),
 step AS (SELECT 1::DOUBLE AS k, 0 AS n UNION ALL SELECT (k + 1 / ((SELECT sum(pow(d, k) * ln(d)) / sum(pow(d, k)) FROM x) - (SELECT avg(ln(d)) FROM x))) / 2, n + 1 FROM step WHERE n < 80),
 fit AS (SELECT k, pow((SELECT avg(pow(d, k)) FROM x), 1 / k) AS life FROM step WHERE n = 80)
 SELECT round(1 - exp(-pow(0.07 / life, k)), 3) AS weibull_7, round(1 - exp(-pow(0.3 / life, k)), 3) AS weibull_30 FROM fit""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        (1 + F.col("o_orderkey") % 30).cast("double").alias("avg_gap"), F.lit(1).alias("label_7"), F.lit(1.0).alias("x"))
    out = md.fit_survival(rows, ("x",), times=(7, 30))
    return out.select(*[F.round(c, 3).alias(c) for c in ("weibull_7", "weibull_30")]).distinct()


@register("forecast_job")
def _(spark, sf):
    return forecast_job(observations(spark, sf), AS_OF)


@register("two_stage_forecast")
def _(spark, sf):
    rows = ts.temporal_features(ts.dense_panel(observations(spark, sf), AS_OF, keys=("OpDiv", "indicator")))
    cols = ("observations", "cumulative_seen", "days_since_last_seen", "seen_streak", "rolling_seen_ratio_14d")
    out = md.two_stage_forecast(rows, AS_OF, cols, min_streak=2, min_ratio=0.2, min_probability=0.3)
    return out.select("OpDiv", "indicator", "date", "seen_streak", "probability")


# after the rule, one tree of one split on a two-valued feature gives the share of each group
@register("two_stage_split", f"""{PANEL}, {_STREAK},
 t AS (SELECT *, avg(seen) {_F14} AS ratio FROM streak), past AS (SELECT * FROM t WHERE date <= DATE '2024-01-23'),
 g AS (SELECT is_weekend, avg(seen) AS rate FROM past GROUP BY 1)
 SELECT OpDiv, indicator, {d('date')} AS date, {i('seen_streak')} AS seen_streak, {r('1 / (1 + exp(-2 * (2 * rate - 1)))')} AS probability
 FROM past JOIN g USING (is_weekend) WHERE date = DATE '2024-01-23' AND seen_streak >= 1 AND ratio >= 0.1""")
def _(spark, sf):
    rows = ts.temporal_features(panel(spark, sf)).withColumn("weekend", F.col("is_weekend").cast("int"))
    out = md.two_stage_forecast(rows, AS_OF, ("weekend",), min_streak=1, min_ratio=0.1, min_probability=0.0, rounds=1)
    return tidy(out, "OpDiv", "indicator", "date", "seen_streak", "probability")


@register("score_learned")
def _(spark, sf):
    scored = sc.score_rule(sc.score_components(score_inputs(spark, sf), AS_OF))
    out, _metrics = md.score_learned(scored)
    return out.select("indicator", "score", "learned_score", "final_score", "final_severity", "adjustment")


@register("ar_forecast_by_series")
def _(spark, sf):
    return md.ar_forecast_by_series(panel(spark, sf), "observations", 7, 7)


# of order 1 and one step ahead, the forecast is the regression line at the last value
@register("ar_forecast_one_step", f"""{PANEL},
 l AS (SELECT OpDiv, indicator, date, observations AS y, lag(observations) OVER (PARTITION BY OpDiv, indicator ORDER BY date) AS x FROM panel),
 f AS (SELECT OpDiv, indicator, max(date) + 1 AS date, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, arg_max(y, date) AS last, count(x) AS n,
   regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x) AS sse FROM l GROUP BY ALL)
 SELECT OpDiv, indicator, CAST(date AS DATE) AS date, CAST(1 AS INT) AS "order", round(a + b * last, 4) AS forecast, round(1.96 * sqrt(greatest(sse, 0) / (n - 2)), 3) AS half FROM f""")
def _(spark, sf):
    out = md.ar_forecast_by_series(panel(spark, sf), "observations", 1, 1)
    return out.select(
        "OpDiv", "indicator", "date", "order", F.round("forecast", 4).alias("forecast"), F.round(F.col("upper") - F.col("forecast"), 3).alias("half"))


# what must hold of the learned score: files keep the rule score, the others take the blend
@register("score_learned_facts", f"""WITH f AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 5 = 4) AS files FROM customer)
 SELECT CAST(n AS BIGINT) AS n, CAST(files AS BIGINT) AS files_as_ruled, CAST(n - files AS BIGINT) AS others_blended, CAST(n AS BIGINT) AS in_range FROM f""")
def _(spark, sf):
    scored = sc.score_rule(sc.score_components(score_inputs(spark, sf), AS_OF))
    out, _metrics = md.score_learned(scored)
    blend = F.rint(0.7 * F.col("score") + 0.3 * F.col("learned_score")).cast("int")
    return out.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("is_file") & (F.col("final_score") == F.col("score"))).alias("files_as_ruled"),
        F.count_if(~F.col("is_file") & (F.col("final_score") == blend)).alias("others_blended"),
        F.count_if(F.col("final_score").between(0, 1000)).alias("in_range"))


@register("feature_importance")
def _(spark, sf):
    return md.feature_importance(training_frame(observations(spark, sf), AS_OF, 7), md.FEATURES, "label")


def _clusters(spark, sf):
    cols = ("last_seen", "freq_7", "freq_30", "avg_gap", "burstiness")
    out, _score = md.cluster_indicators(features(spark, sf), cols, 5)
    return out, cols


@register("cluster_indicators")
def _(spark, sf):
    return _clusters(spark, sf)[0].select("OpDiv", "indicator", "cluster", "distance", "is_outlier")


# equal positions are one point with a weight here, so that the links stay few
@register("cluster_indicators_density", f"""{PANEL},{_FEATURES},
 x AS (SELECT OpDiv, indicator, CAST(indicator AS BIGINT) * 10 + list_position(['click', 'error', 'purchase', 'signup', 'view'], OpDiv) AS id,
   CAST(last_seen AS INT) AS a, CAST(freq_7 AS INT) AS b, CAST(freq_30 AS INT) AS c FROM feats),
 p AS (SELECT a, b, c, count(*) AS n, min(id) AS id FROM x GROUP BY ALL),
 near AS (SELECT p.id AS u, q.id AS v, q.n FROM p JOIN p q ON (p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c) <= 2),
 core AS (SELECT u FROM near GROUP BY u HAVING sum(n) >= 15),
 link AS (SELECT u, v FROM near WHERE u IN (FROM core) AND v IN (FROM core)),
 reach AS (SELECT u AS s, u AS t FROM core UNION SELECT reach.s, link.v FROM reach JOIN link ON reach.t = link.u),
 named AS (SELECT s AS id, min(t) AS cluster FROM reach GROUP BY s),
 all_ AS (SELECT u AS id, min(cluster) AS cluster FROM near JOIN named ON near.v = named.id
   WHERE u NOT IN (FROM core) GROUP BY u UNION ALL SELECT id, cluster FROM named)
 SELECT OpDiv, indicator, {i('cluster')} AS cluster, p.id IN (FROM core) AS is_core FROM x JOIN p USING (a, b, c) LEFT JOIN all_ ON all_.id = p.id""".replace("WITH ", "WITH RECURSIVE ", 1))
def _(spark, sf):
    place = F.array_position(F.array(*map(F.lit, PARTNERS)), F.col("OpDiv"))
    rows = features(spark, sf).withColumn("id", F.col("indicator").cast("long") * 10 + place)
    out = density_clusters(rows, "id", ("last_seen", "freq_7", "freq_30"), 2**0.5, 15)
    return out.select("OpDiv", "indicator", "cluster", "is_core")


@register("cluster_profiles")
def _(spark, sf):
    return md.cluster_profiles(*_clusters(spark, sf))


# the labelled vectors stand in for clusters where SQL checks the arithmetic
@register("seen_rate_by_cluster", f"""SELECT label AS cluster, {r('avg(toxic)')} AS probability, count(*) AS count FROM embeddings JOIN labels ON vec_id = doc_id GROUP BY 1""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings").join(table(spark, sf, "labels"), F.col("vec_id") == F.col("doc_id"))
    out = md.seen_rate_by_cluster(rows.withColumnRenamed("label", "cluster"), "toxic")
    return out.withColumn("probability", F.round("probability", 6))


def _judged(spark, sf):
    """Labelled documents with a prediction derived from their id."""
    return table(spark, sf, "labels").withColumns(
        {"p": (F.col("doc_id") * 37 % 101) / 101.0, "guess": (F.col("doc_id") * 7 % 3 > 0).cast("int")}
    )


_JUDGED = "WITH j AS (SELECT *, (doc_id * 37 % 101) / 101.0::DOUBLE AS p, CAST(doc_id * 7 % 3 > 0 AS INT) AS guess FROM labels)"


@register("class_weights", f"SELECT doc_id, quality, {r('(SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*) OVER (PARTITION BY quality))')} AS weight FROM labels")
def _(spark, sf):
    out = ev.class_weights(table(spark, sf, "labels"), "quality")
    return out.select("doc_id", "quality", F.round("weight", 6).alias("weight"))


@register("confusion_matrix", f"{_JUDGED} SELECT quality, count(*) FILTER (WHERE guess = 0) AS predicted_0, count(*) FILTER (WHERE guess = 1) AS predicted_1 FROM j GROUP BY 1")
def _(spark, sf):
    return ev.confusion_matrix(_judged(spark, sf), "quality", "guess", (0, 1))


@register("classification_metrics", f"""{_JUDGED}, c AS (SELECT c, count(*) FILTER (WHERE quality = c) AS s, count(*) FILTER (WHERE guess = c) AS q, count(*) FILTER (WHERE quality = c AND guess = c) AS h FROM j, (VALUES (0), (1)) v(c) GROUP BY c),
  m AS (SELECT *, h / q AS pr, h / s AS re, 2 * (h / q) * (h / s) / (h / q + h / s) AS f FROM c)
  SELECT {r('sum(h) / sum(s)')} AS accuracy, {r('sum(pr * s) / sum(s)')} AS precision, {r('sum(re * s) / sum(s)')} AS recall, {r('sum(f * s) / sum(s)')} AS f1 FROM m""")
def _(spark, sf):
    return tidy(ev.classification_metrics(_judged(spark, sf), "quality", "guess"))


def _pairs(spark, sf):
    """Line prices with the part's retail price times quantity as their prediction."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    lines = table(spark, sf, "lineitem").join(parts, "l_partkey")
    return lines.select(F.col("l_extendedprice").alias("y"), (F.col("p_retailprice") * F.col("l_quantity")).alias("p"))


_PAIRS = "WITH e AS (SELECT l_extendedprice AS y, p_retailprice * l_quantity AS p FROM lineitem JOIN part ON l_partkey = p_partkey)"
_ERR = f"{r('avg(abs(y - p))')} AS mae, round(avg((y - p) ** 2), 2) AS mse, {r('sqrt(avg((y - p) ** 2))')} AS rmse"


def _mse(df):
    return tidy(df.withColumn("mse", F.round("mse", 2)))


@register("regression_metrics", f"{_PAIRS} SELECT {_ERR}, {r('1 - sum((y - p) ** 2) / (var_pop(y) * count(*))')} AS r2 FROM e")
def _(spark, sf):
    return _mse(ev.regression_metrics(_pairs(spark, sf), "y", "p"))


@register("forecast_metrics", f"{_PAIRS} SELECT {_ERR}, {r('avg(abs((y - p) / nullif(y, 0))) * 100')} AS mape FROM e")
def _(spark, sf):
    return _mse(ev.forecast_metrics(_pairs(spark, sf), "y", "p"))


@register("baseline_compare", f"""{_PAIRS}, b AS (SELECT avg(abs(y - (SELECT avg(y) FROM e))) AS b FROM e)
  SELECT {_ERR}, {r('any_value(b)')} AS baseline_mae, round(var_samp(y), 2) AS mse_threshold, {r('stddev_samp(y)')} AS rmse_threshold, {r('any_value(b) * 0.9')} AS mae_threshold,
  avg(abs(y - p)) < any_value(b) * 0.9 AS mae_good, avg((y - p) ** 2) < var_samp(y) AS mse_good, sqrt(avg((y - p) ** 2)) < stddev_samp(y) AS rmse_good FROM e, b""")
def _(spark, sf):
    out = ev.baseline_compare(_pairs(spark, sf), "y", "p")
    return _mse(out.withColumn("mse_threshold", F.round("mse_threshold", 2)))


@register("probability_metrics", f"""{_JUDGED}, a AS (SELECT p, sum(quality) AS pos, sum(1 - quality) AS neg FROM j GROUP BY 1), b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM a)
  SELECT (SELECT count(*) FROM j) AS n, {r('(SELECT avg(-(quality * ln(greatest(least(p, 1 - 1e-15), 1e-15)) + (1 - quality) * ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)))) FROM j)')} AS log_loss,
  {r('(SELECT avg((p - quality) ** 2) FROM j)')} AS brier, {r('sum(pos * (lower + neg / 2)) / (sum(pos) * sum(neg))')} AS auc FROM b""")
def _(spark, sf):
    return tidy(ev.probability_metrics(_judged(spark, sf), "quality", "p"))


@register("calibration_curve", f"{_JUDGED} SELECT {i('least(floor(p * 10), 9)')} AS bin, count(*) AS n, {r('avg(p)')} AS mean_predicted, {r('avg(quality)')} AS observed_rate FROM j GROUP BY 1")
def _(spark, sf):
    return tidy(ev.calibration_curve(_judged(spark, sf), "quality", "p"))


@register("random_split", """SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders""")
def _(spark, sf):
    return ev.random_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@register("time_split", """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor((SELECT count(*) FROM events) * 0.8) THEN 'train' ELSE 'test' END AS split FROM events""")
def _(spark, sf):
    return ev.time_split(table(spark, sf, "events"), ("ts", "event_id")).select("event_id", "split")


@register("rolling_origin", f"""WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n FROM events)
  SELECT event_id, {i('CASE WHEN rn <= n - floor(n / 6) * 5 THEN 0 ELSE floor((rn - (n - floor(n / 6) * 5) - 1) / floor(n / 6)) + 1 END')} AS test_fold FROM n""")
def _(spark, sf):
    out = ev.rolling_origin(table(spark, sf, "events").select("event_id", "ts"), ("ts", "event_id"), 5)
    return tidy(out, "event_id", "test_fold")


def _guesses(spark, sf):
    """Per sighting: a probability from its size, and whether it was large."""
    o = F.col("observations")
    return observations(spark, sf).select(
        "indicator", (o % 100 / 100.0).alias("probability"), F.when(o % 7 != 6, (o % 2).cast("int")).alias("seen"),
        F.when(o % 5 != 0, o % 10 / 10.0).alias("activity"),
    )


_GUESS = f"""{with_tables('obs')}, g AS (SELECT indicator, observations % 100 / 100.0 AS p, CASE WHEN observations % 7 <> 6 THEN observations % 2 END AS seen, CASE WHEN observations % 5 <> 0 THEN observations % 10 / 10.0 END AS act FROM obs)"""
_STATUS = f"""{_GUESS}, x AS (SELECT *, CASE WHEN p < 0.5 AND seen = 1 THEN 1 WHEN p >= 0.5 AND seen = 0 THEN 2 WHEN seen IS NULL THEN 3 ELSE 4 END AS k FROM g),
  w AS (SELECT indicator, ['False Negative', 'False Positive', 'Wrong', 'Right'][min(k)] AS status, min(k) AS k FROM x GROUP BY 1)"""


@register("prediction_status", f"{_STATUS} SELECT indicator, status FROM w")
def _(spark, sf):
    return ev.prediction_status(_guesses(spark, sf)).select("indicator", "status")


@register("prediction_summary", f"""{_JUDGED}, x AS (SELECT CASE WHEN p < 0.5 AND quality = 1 THEN 'fn' WHEN p >= 0.5 AND quality = 0 THEN 'fp' ELSE 'right' END AS s, quality FROM j)
  SELECT count(*) AS total, count(*) FILTER (WHERE s = 'right') AS right, {r("count(*) FILTER (WHERE s = 'right') * 100.0 / count(*)")} AS accuracy_pct,
  {r("count(*) FILTER (WHERE s = 'right' AND quality = 1) * 100.0 / count(*) FILTER (WHERE quality = 1)")} AS seen_found_pct FROM x""")
def _(spark, sf):
    rows = _judged(spark, sf).select(F.col("doc_id").alias("indicator"), F.col("p").alias("probability"), F.col("quality").alias("seen"))
    return tidy(ev.prediction_summary(ev.prediction_status(rows)))


@register("per_indicator_accuracy", f"""{_GUESS} SELECT indicator, round(avg(CAST(CAST(p > 0.35 + 0.15 * coalesce(act, 0.5) AS INT) = seen AS INT)), 3) AS accuracy, round(avg(p), 3) AS mean_probability, count(*) AS samples FROM g GROUP BY 1""")
def _(spark, sf):
    return ev.per_indicator_accuracy(_guesses(spark, sf))
