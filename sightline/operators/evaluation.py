"""Evaluation: metrics, calibration, splits and forecast hit rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small
from .ordering import running_totals
from .timeseries import first_rows, rank_narrow


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight ``n / (classes · n_class)`` on every row."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n"))
    whole = counts.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k"))).scalar()
    weights = small(counts.select(label, (whole["n"] / (whole["k"] * F.col("_n"))).alias(out)))
    return df.join(weights, label)


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence) -> DataFrame:
    """Rows: true label; one count column per predicted label."""
    return df.groupBy(y).agg(*[F.count_if(F.col(p) == v).alias(f"predicted_{v}") for v in labels])


def classification_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 in one row."""
    cells = df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select(
        F.explode(F.array(F.struct(F.col("y").alias("c"), F.lit(1).alias("t"), F.lit(0).alias("q")),
                          F.struct(F.col("p").alias("c"), F.lit(0).alias("t"), F.lit(1).alias("q")))).alias("s"),
        "n", (F.col("y") == F.col("p")).alias("hit"),
    )
    classes = sides.groupBy("s.c").agg(
        F.sum(F.col("n") * F.col("s.t")).alias("support"),
        F.sum(F.col("n") * F.col("s.q")).alias("predicted"),
        F.sum(F.when(F.col("hit"), F.col("n") * F.col("s.t")).otherwise(0)).alias("hits"),
    )
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    f1 = F.when(F.col("hits") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    total = F.sum("support")

    def weighted(value: Column) -> Column:
        return F.sum(value * F.col("support")) / total

    return classes.agg(
        (F.sum("hits") / total).alias("accuracy"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"),
        weighted(f1).alias("f1"),
    )


def _errors(y: str, p: str) -> dict[str, Column]:
    e = F.col(y) - F.col(p)
    mse = F.avg(e * e)
    return {"mae": F.avg(F.abs(e)), "mse": mse, "rmse": F.sqrt(mse)}


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    e = F.col(y) - F.col(p)
    r2 = 1 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))
    return df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).agg(
        *[v.alias(k) for k, v in _errors(y, p).items()], r2.alias("r2")
    )


def forecast_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """Errors with the mean absolute percentage error; true zeros are left out of the latter."""
    share = F.abs((F.col(y) - F.col(p)) / F.nullif(F.col(y), F.lit(0)))
    return df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).agg(
        *[v.alias(k) for k, v in _errors(y, p).items()], (F.avg(share) * 100).alias("mape")
    )


def probability_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """AUC (ties count half), log-loss and Brier score in one row."""
    rows = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).select(
        F.col(y).cast("int").alias("y"), F.col(p).cast("double").alias("p")
    )
    counts = rows.groupBy("p").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    placed = running_totals(counts, "p", ["neg"])
    pairs = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    auc = placed.agg((pairs / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc")).scalar()
    safe = F.least(F.greatest("p", F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(F.col("y") * F.log(safe) + (1 - F.col("y")) * F.log(1 - safe))
    gap = F.col("p") - F.col("y")
    return rows.agg(
        F.count("*").alias("n"), F.avg(loss).alias("log_loss"), F.avg(gap * gap).alias("brier")
    ).withColumn("auc", auc)


def calibration_curve(df: DataFrame, y: str, p: str, bins: int = 10) -> DataFrame:
    """Mean prediction and observed rate per equal-width probability bin."""
    slot = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1))
    return df.groupBy(slot.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(p).alias("mean_predicted"), F.avg(y).alias("observed_rate")
    )


def baseline_compare(df: DataFrame, y: str, p: str) -> DataFrame:
    """Errors against the mean predictor and whether they pass the thresholds."""
    rows = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    mean = rows.agg(F.avg(y)).scalar()
    rows = rows.withColumn("_base", F.abs(F.col(y) - mean))
    out = rows.agg(
        *[v.alias(k) for k, v in _errors(y, p).items()],
        F.avg("_base").alias("baseline_mae"),
        F.var_samp(y).alias("mse_threshold"),
        F.stddev_samp(y).alias("rmse_threshold"),
    )
    return out.withColumn("mae_threshold", F.col("baseline_mae") * 0.9).withColumns(
        {f"{m}_good": F.col(m) < F.col(f"{m}_threshold") for m in ("mae", "mse", "rmse")}
    )


def random_split(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42) -> DataFrame:
    """``split`` = train or test by a hash of the unique key, so a retried task decides the same."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return df.withColumn("split", F.when(share < frac, "train").otherwise("test"))


def time_split(df: DataFrame, order: Sequence[str], frac: float = 0.8) -> DataFrame:
    """The first ``frac`` of the rows in ``order`` (ending in a unique key) train, the rest test."""
    n = F.floor(df.agg(F.count("*")).scalar() * F.lit(frac))
    ranking = [(c, False) for c in order]
    first = first_rows(rank_narrow(df, ranking), ranking, n)
    return df.withColumn("split", F.when(first, "train").otherwise("test"))


def rolling_origin(df: DataFrame, order: Sequence[str], folds: int = 5) -> DataFrame:
    """``test_fold`` of every row in expanding-window validation.

    Fold ``f`` is tested on the rows with ``test_fold = f`` and trained on all rows below it.
    Only the ordering columns, ending in a unique key, are sorted; the rows at the folds' edges then
    tell the fold of every wide row where it is.
    """
    total = df.agg(F.count("*")).scalar()
    ranking = [(c, False) for c in order]
    ranked = rank_narrow(df, ranking)
    size = F.floor(total / (folds + 1))
    first = total - size * folds
    beyond = [(~first_rows(ranked, ranking, first + size * k)).cast("int") for k in range(folds)]
    fold = beyond[0]
    for later in beyond[1:]:
        fold = fold + later
    return df.withColumn("test_fold", fold)


def prediction_status(df: DataFrame, probability: str = "probability", seen: str = "seen") -> DataFrame:
    """Right, False Negative or False Positive at 0.5; an indicator's worst status wins."""
    high, hit = F.col(probability) >= 0.5, F.col(seen) == 1
    status = (
        F.when(~high & hit, "False Negative").when(high & (F.col(seen) == 0), "False Positive")
        .when((high & hit) | (~high & (F.col(seen) == 0)), "Right").otherwise("Wrong")
    )
    rank = (
        F.when(F.col("status") == "False Negative", 1).when(F.col("status") == "False Positive", 2)
        .when(F.col("status") == "Wrong", 3).otherwise(4)
    )
    rows = df.withColumn("status", status)
    return rows.groupBy("indicator").agg(
        F.min_by("status", rank).alias("status"), F.min_by(seen, rank).alias("seen")
    )


def prediction_summary(statuses: DataFrame) -> DataFrame:
    """Share of right predictions and of seen indicators that were found."""
    right, seen = F.col("status") == "Right", F.col("seen") == 1
    return statuses.agg(
        F.count("*").alias("total"),
        F.count_if(right).alias("right"),
        (F.count_if(right) * 100 / F.count("*")).alias("accuracy_pct"),
        (F.count_if(right & seen) * 100 / F.nullif(F.count_if(seen), F.lit(0))).alias("seen_found_pct"),
    )


def per_indicator_accuracy(
    df: DataFrame, y: str = "seen", probability: str = "probability", activity: str = "activity"
) -> DataFrame:
    """Hit rate per indicator with the row's own threshold ``0.35 + 0.15·activity``."""
    # without an activity value the middle of its range is assumed
    threshold = 0.35 + 0.15 * F.coalesce(F.col(activity), F.lit(0.5))
    guess = (F.col(probability) > threshold).cast("int")
    return df.groupBy("indicator").agg(
        F.round(F.avg((guess == F.col(y)).cast("int")), 3).alias("accuracy"),
        F.round(F.avg(probability), 3).alias("mean_probability"),
        F.count("*").alias("samples"),
    )
