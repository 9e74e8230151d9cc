"""Forecast, scoring and clustering models on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import AFTSurvivalRegression, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import severity
from ..session import pin
from .ordering import exact_quantiles
from .timeseries import SERIES, latest_row

FEATURES = ("last_seen", "freq_1", "freq_7", "freq_14", "freq_30", "freq_45", "avg_gap", "burstiness")
SURVIVAL_FEATURES = ("last_seen", "freq_1", "freq_14", "freq_30", "freq_45", "burstiness")


def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"_{c}": F.col(c).cast("double") for c in cols})


def _prepare(features: Sequence[str]) -> list:
    """Median imputation and assembly of the ``_``-prefixed copies of the features."""
    raw, filled = [f"_{c}" for c in features], [f"_{c}_filled" for c in features]
    return [
        Imputer(strategy="median", inputCols=raw, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="_vector"),
    ]


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def _single_class(rows: DataFrame, label: str) -> bool:
    """Two rows are enough to tell, so nothing larger reaches the driver."""
    return len(rows.select(label).distinct().limit(2).collect()) < 2


Scorer = Callable[[DataFrame], DataFrame]


def _labelled(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    rows = _numbers(train, features).where(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("double"))
    return rows.select(*[f"_{c}" for c in features], "_label")


def _probability(model: PipelineModel | None, features: Sequence[str], out: str) -> Scorer:
    if model is None:  # one class only
        return lambda target: target.withColumn(out, F.lit(None).cast("double"))

    def score(target: DataFrame) -> DataFrame:
        scored = model.transform(_numbers(target, features))
        return _plain(scored.withColumn(out, vector_to_array("_probability")[1]))

    return score


TASK_ROWS, TASK_MOST = 20_000, 1_000_000  # rows that a task of a fit in many passes reads at least and at most


def equal_parts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Written rows in equal parts, one a core, for a fit of very many passes.

    Each pass starts and merges a task per part, so parts beyond the cores cost more than their rows.
    """
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, n // TASK_MOST, min(cores, n // TASK_ROWS))
    return rows.repartition(parts, *by).sortWithinPartitions(*by)


def _medians(counted: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Median of each column over the rows that ``_weight`` counts, without nulls and NaN."""
    values = counted.select("_weight", *cols).unpivot("_weight", list(cols), "_column", "_value").where(~F.isnan("_value"))
    found = exact_quantiles(values, "_value", (0.5,), ("_column",), "_weight").collect()  # a row per column
    if len(found) < len(cols):
        raise ValueError(f"no value to impute: {', '.join(sorted(set(cols) - {r['_column'] for r in found}))}")
    return {r["_column"]: r["q0"] for r in found}


_OUTPUTS = dict(labelCol="_label", predictionCol="_prediction", probabilityCol="_probability", rawPredictionCol="_raw")


def logistic_scorer(
    train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label_7", c: float = 1.0, out: str = "logistic"
) -> Scorer:
    """Fit ``fit_logistic``'s model and return what adds its probability to a frame of features."""
    rows = _labelled(train, features, label)
    if _single_class(rows, "_label"):
        return _probability(None, features, out)
    scaler = StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True, withStd=True)
    # the penalty is per row here, so it shrinks with the number of rows
    ridge = LogisticRegression(
        featuresCol="_scaled", regParam=1.0 / (c * rows.count()), standardization=False, maxIter=2000, **_OUTPUTS
    )
    return _probability(Pipeline(stages=[*_prepare(features), scaler, ridge]).fit(rows), features, out)


def fit_logistic(
    train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label_7", c: float = 1.0,
    out: str = "logistic", apply_to: DataFrame | None = None,
) -> DataFrame:
    """Probability of the label: median imputation, standard scaling, ridge logistic regression.

    Scores ``apply_to``, or the training rows themselves.  A single-class label gives nulls.
    """
    return logistic_scorer(train, features, label, c, out)(train if apply_to is None else apply_to)


def boosted_scorer(
    train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label_7", rounds: int = 100,
    depth: int = 3, step: float = 0.1, seed: int = 42, out: str = "boosted",
) -> Scorer:
    """Fit ``fit_boosted``'s model and return what adds its probability to a frame of features.

    Trees see a row only by its values and weight, so equal rows become one that weighs their number.
    The many passes of the fit then read distinct rows, written once, in equal parts, and not the plan of ``train``.
    """
    cols = [f"_{c}" for c in features]
    counted = pin(_labelled(train, features, label).groupBy(*cols, "_label").agg(F.count("*").cast("double").alias("_weight")))
    if _single_class(counted, "_label"):
        return _probability(None, features, out)
    medians = _medians(counted, cols)
    counted = equal_parts(counted, (*cols, "_label"))
    filled = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"coalesce(nanvl(`{c}`, NULL), CAST('{medians[c]!r}' AS DOUBLE)) AS `{c}_filled`" for c in cols) + " FROM __THIS__")
    assembler = VectorAssembler(inputCols=[f"{c}_filled" for c in cols], outputCol="_vector")
    trees = GBTClassifier(
        featuresCol="_vector", labelCol="_label", predictionCol="_prediction", weightCol="_weight", maxIter=rounds,
        maxDepth=depth, stepSize=step, seed=seed,
    )
    trees = trees.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    return _probability(Pipeline(stages=[filled, assembler, trees]).fit(counted), features, out)


def fit_boosted(
    train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label_7", rounds: int = 100,
    depth: int = 3, step: float = 0.1, seed: int = 42, out: str = "boosted", apply_to: DataFrame | None = None,
) -> DataFrame:
    """Probability of the label by boosted trees; a single-class label gives nulls."""
    return boosted_scorer(train, features, label, rounds, depth, step, seed, out)(train if apply_to is None else apply_to)


def survival_scorer(
    train: DataFrame, features: Sequence[str] = SURVIVAL_FEATURES, duration: str = "avg_gap",
    event: str = "label_7", times: Sequence[int] = (1, 7, 14, 30, 45), scale: float = 100.0, out: str = "weibull",
) -> Scorer:
    """Fit ``fit_survival``'s model and return what adds its probabilities to a frame of features."""
    rows = _numbers(train, features).where(F.col(duration).isNotNull() & F.col(event).isNotNull())
    rows = rows.withColumns(
        {
            "_duration": F.greatest(F.col(duration) / scale, F.lit(1e-6)),
            "_event": F.col(event).cast("double"),
        }
    )
    if len(rows.select(duration).limit(5).collect()) < 5:
        return lambda target: target.withColumns({f"{out}_{t}": F.lit(None).cast("double") for t in times})
    aft = AFTSurvivalRegression(
        featuresCol="_vector", labelCol="_duration", censorCol="_event", predictionCol="_lifetime"
    )
    model = Pipeline(stages=[*_prepare(features), aft]).fit(rows)
    shape = 1.0 / model.stages[-1].scale

    def score(target: DataFrame) -> DataFrame:
        scored = model.transform(_numbers(target, features))
        return _plain(
            scored.withColumns(
                {f"{out}_{t}": 1 - F.exp(-F.pow(F.lit(t / scale) / F.col("_lifetime"), F.lit(shape))) for t in times}
            )
        )

    return score


def fit_survival(
    train: DataFrame, features: Sequence[str] = SURVIVAL_FEATURES, duration: str = "avg_gap",
    event: str = "label_7", times: Sequence[int] = (1, 7, 14, 30, 45), scale: float = 100.0,
    out: str = "weibull", apply_to: DataFrame | None = None,
) -> DataFrame:
    """``<out>_<t>``: Weibull probability of an event within t days; null below five rows."""
    scorer = survival_scorer(train, features, duration, event, times, scale, out)
    return scorer(train if apply_to is None else apply_to)


def two_stage_forecast(
    panel_features: DataFrame, as_of: str, features: Sequence[str], gap_days: int = 7, min_streak: int = 3,
    min_ratio: float = 0.5, min_probability: float = 0.60, rounds: int = 100, keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Indicators expected to be seen: a streak and ratio rule, then boosted trees.

    Trained on the days up to ``as_of − gap_days``; the latest such row per series is scored.
    """
    cut = F.date_sub(F.lit(as_of).cast("date"), gap_days)
    train = panel_features.where(F.col("date") <= cut)
    last = latest_row(panel_features.where(F.col("date") <= cut), as_of, keys)
    ready = last.where((F.col("seen_streak") >= min_streak) & (F.col("rolling_seen_ratio_14d") >= min_ratio))
    scored = fit_boosted(train, features, "seen", rounds, out="probability", apply_to=ready)
    return scored.where(F.col("probability") >= min_probability)


# 17 inputs of the learned score: raw inputs, component values and factors
SCORE_FEATURES = (
    "vt_value", "obs_days", "rating", "confidence", "cal_score", "external_score", "tor", "incident_part",
    "sources_count", "partners_count", "actor_part", "first_seen_part", "context_bonus", "botnet_flag",
    "false_positives", "scanner_factor", "quality_factor",
)

def score_learned(
    scored: DataFrame, seed: int = 42, rounds: int = 300, key: str = "indicator"
) -> tuple[DataFrame, DataFrame]:
    """Boosted trees that learn the rule score, blended 0.7 / 0.3; files keep the rule score.

    Trained on the 80 % of keys with the smallest hash.  Returns the blended scores and one row
    with the error on the other 20 %.
    """
    rows = scored.withColumn("botnet_flag", F.col("has_botnet").cast("int"))
    rows = rows.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SCORE_FEATURES})
    rows = rows.withColumn("_label", F.col("score").cast("double"))
    share = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1000)) / 1000
    # the many passes of the fit read a narrow copy, and not the scoring plan anew
    spot = F.xxhash64(F.col(key), F.lit(seed + 1))
    narrow = pin(rows.select("_label", share.alias("_share"), spot.alias("_spot"), *[f"_{c}" for c in SCORE_FEATURES]))
    narrow = equal_parts(narrow, ("_spot",))
    train, test = narrow.where("_share < 0.8"), narrow.where("_share >= 0.8")
    trees = GBTRegressor(
        featuresCol="_vector", labelCol="_label", predictionCol="_prediction", maxDepth=6, stepSize=0.05,
        maxIter=rounds, seed=seed,
    )
    assembler = VectorAssembler(inputCols=[f"_{c}" for c in SCORE_FEATURES], outputCol="_vector")
    model = Pipeline(stages=[assembler, trees]).fit(train)
    checked = model.transform(test)
    error = F.col("_label") - F.col("_prediction")
    metrics = checked.agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / (F.var_pop("_label") * F.count("*"))).alias("r2"),
    )
    learned = F.rint(F.least(F.greatest("_prediction", F.lit(0.0)), F.lit(1000.0)))
    blend = F.rint(0.7 * F.col("score") + 0.3 * F.col("learned_score")).cast("int")
    out = model.transform(rows).withColumn("learned_score", learned.cast("int"))
    out = out.withColumn("final_score", F.when(F.col("is_file"), F.col("score")).otherwise(blend))
    out = out.withColumns(
        {
            "final_severity": severity(F.col("final_score")),
            "adjustment": F.col("final_score") - F.col("score"),
        }
    )
    return _plain(out).drop("botnet_flag"), metrics


def feature_importance(
    df: DataFrame, features: Sequence[str], label: str, n: int = 10, trees: int = 100, seed: int = 42
) -> DataFrame:
    """The ``n`` most important features by a random forest."""
    rows = _numbers(df, features).withColumn("_label", F.col(label).cast("double"))
    forest = RandomForestClassifier(featuresCol="_vector", labelCol="_label", numTrees=trees, seed=seed)
    model = Pipeline(stages=[*_prepare(features), forest]).fit(rows)
    weights = [float(w) for w in model.stages[-1].featureImportances.toArray()]
    table = df.sparkSession.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature").limit(n)


def cluster_indicators(
    df: DataFrame, features: Sequence[str], k: int = 8, outlier_share: float = 0.05, seed: int = 42
) -> tuple[DataFrame, float]:
    """Cluster standardized features; the farthest ``outlier_share`` of rows are outliers (−1).

    Returns the rows with ``cluster``, ``distance`` and ``is_outlier``, and the silhouette.
    """
    rows = df.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    stages = [
        VectorAssembler(inputCols=[f"_{c}" for c in features], outputCol="_vector"),
        StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True),
        KMeans(featuresCol="_scaled", predictionCol="_cluster", k=k, seed=seed),
    ]
    model = Pipeline(stages=stages).fit(rows)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.stages[-1].clusterCenters()])
    placed = model.transform(rows)
    silhouette = ClusteringEvaluator(featuresCol="_scaled", predictionCol="_cluster").evaluate(placed)
    gaps = F.zip_with(vector_to_array("_scaled"), F.get(centres, F.col("_cluster")), lambda a, b: (a - b) * (a - b))
    placed = placed.withColumn("distance", F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)))
    limit = exact_quantiles(placed, "distance", (1 - outlier_share,)).select("q0").scalar()
    placed = placed.withColumn("is_outlier", F.col("distance") > limit)
    cluster = F.when(F.col("is_outlier"), -1).otherwise(F.col("_cluster"))
    return _plain(placed.withColumn("cluster", cluster)), silhouette


def cluster_profiles(clustered: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean of each feature per cluster and its deviation from the mean over clusters."""
    means = clustered.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in features])
    long = means.unpivot(["cluster"], list(features), "feature", "mean")
    overall = long.groupBy("feature").agg(F.avg("mean").alias("_all"))
    return long.join(overall, "feature").withColumn("deviation", F.col("mean") - F.col("_all")).drop("_all")


def seen_rate_by_cluster(clustered: DataFrame, seen: str = "seen") -> DataFrame:
    return clustered.groupBy("cluster").agg(F.avg(seen).alias("probability"), F.count("*").alias("count"))


# ------------------------------------------------------------------------------- per series


def apply_per_series(
    df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Run ``fn`` on every series.  Use it on panels, whose series have one row per day."""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def _fit_many(x: np.ndarray, max_p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order, coefficients, spread and AIC of every row of ``x``, all series of one length.

    Least-squares autoregressions; the order with the smallest AIC on a common sample.  Too short for a lag:
    order 0, the mean with the spread of the values, and no AIC.
    """
    m, n = x.shape
    top = min(max_p, (n - 2) // 3)
    if top < 1:
        count = (~np.isnan(x)).sum(axis=1)
        mean = np.where(count > 0, np.nansum(x, axis=1) / np.maximum(count, 1), np.nan)
        spread = np.nansum((x - mean[:, None]) ** 2, axis=1) / np.maximum(count - 1, 1)
        return np.zeros(m, int), mean[:, None], np.where(count > 1, np.sqrt(spread), np.nan), np.full(m, np.nan)
    y = x[:, top:]
    order, beta = np.zeros(m, int), np.zeros((m, top + 1))
    sigma, aic = np.zeros(m), np.full(m, np.inf)
    for p in range(1, top + 1):
        design = np.stack([np.ones(y.shape)] + [x[:, top - k : n - k] for k in range(1, p + 1)], axis=2)
        inverse = np.linalg.pinv(design, rcond=np.finfo(float).eps * max(design.shape[1:]))
        found = np.matmul(inverse, y[:, :, None])
        sse = ((y - np.matmul(design, found)[:, :, 0]) ** 2).sum(axis=1)
        rank = y.shape[1] * np.log(np.maximum(sse / y.shape[1], 1e-12)) + 2 * (p + 2)
        better = (rank < aic - 1e-9) | (order == 0)
        order[better], aic[better] = p, rank[better]
        sigma[better] = np.sqrt(sse / max(y.shape[1] - p - 1, 1))[better]
        beta[better, : p + 1] = found[better, :, 0]
    return order, beta, sigma, aic


def _fit_ar(x: np.ndarray, max_p: int) -> tuple[int, np.ndarray, float, float] | None:
    """The fit of one series; None if it is too short for a lag."""
    order, beta, sigma, aic = (v[0] for v in _fit_many(x[None, :], max_p))
    return (int(order), beta[: order + 1], float(sigma), float(aic)) if order else None


AR_ROWS = 1_000  # series that are fitted at once, which bounds a task's memory


def _forecast_series(batches: Iterator[pa.RecordBatch], keys: list[str], max_p: int, h: int) -> Iterator[pa.RecordBatch]:
    """``h`` rows for every row of keys, days and values; series of one length are fitted together."""
    slices = (b.slice(i, AR_ROWS) for b in batches for i in range(0, b.num_rows, AR_ROWS))
    for batch in slices:
        days, values = batch.column("_days"), batch.column("_values")
        ends = np.cumsum(days.value_lengths().to_numpy(zero_copy_only=False))
        lengths = np.diff(ends, prepend=0)
        every = values.flatten().to_numpy(zero_copy_only=False).astype(float)
        last = days.flatten().cast(pa.int32()).to_numpy(zero_copy_only=False)[ends - 1]
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            x = every[(ends[at] - n)[:, None] + np.arange(n)]
            order, beta, sigma, aic = _fit_many(x, max_p)
            lags = beta.shape[1] - 1
            history, psi, total = [x[:, i] for i in range(n)], [np.ones(len(at))], np.zeros(len(at))
            out = []
            for step in range(1, h + 1):
                value = beta[:, 0] + sum(beta[:, k] * history[-k] for k in range(1, lags + 1))
                history.append(value)
                total = total + psi[-1] ** 2
                width = 1.96 * sigma * np.sqrt(total)
                psi.append(sum((beta[:, k] * psi[-k] for k in range(1, min(lags, len(psi)) + 1)), np.zeros(len(at))))
                out.append((last[at] + step, order, aic, value, value - width, value + width))
            date, *rest = (np.stack(c, axis=1).reshape(-1) for c in zip(*out))
            rows = pa.array(np.repeat(at, h))
            cols = [batch.column(k).take(rows) for k in keys]
            cols += [pa.array(date, pa.int32()).cast(pa.date32()), pa.array(rest[0], pa.int32()), *map(pa.array, rest[1:])]
            yield pa.RecordBatch.from_arrays(cols, [*keys, "date", "order", "aic", "forecast", "lower", "upper"])


def ar_forecast_by_series(
    panel: DataFrame, col: str = "observations", max_p: int = 7, h: int = 7, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Autoregressive forecast with a 95 % band for every series, ``h`` days ahead.

    A series, which has a row per day, becomes one row; a task fits many of them at once.  A series too
    short for a lag gets order 0: its mean, and no band if it has one value.
    """
    kinds = ", ".join(f"`{k}` {panel.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, date date, `order` int, aic double, forecast double, lower double, upper double"
    pairs = F.sort_array(F.collect_list(F.struct(F.col("date").cast("date").alias("d"), F.col(col).cast("double").alias("v"))))
    series = panel.groupBy(*keys).agg(pairs.alias("_s")).select(*keys, F.col("_s.d").alias("_days"), F.col("_s.v").alias("_values"))
    fn = partial(_forecast_series, keys=list(keys), max_p=max_p, h=h)
    return series.mapInArrow(lambda batches: fn(batches), schema)
