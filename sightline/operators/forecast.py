"""Forecast arithmetic that needs no fitted model: hazard, rules, ensemble, confidence, log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions.columns import percent_text
from ..session import small

HORIZONS = (1, 7, 14, 30, 45)
# fixed ensemble weights: logistic, boosted trees, Weibull, exponential
WEIGHTS = {"logistic": 0.30, "boosted": 0.25, "weibull": 0.25, "exp": 0.20}
# first version: the exponential part weighs .30, so the weights sum to 1.1
WEIGHTS_V1 = {"logistic": 0.30, "boosted": 0.25, "weibull": 0.25, "exp": 0.30}


def exp_hazard(features: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Memoryless chance of a sighting within h days from the 30-day rate."""
    rate = F.greatest(F.coalesce(F.col("freq_30"), F.lit(0)) / 30.0, F.lit(1e-6))
    return features.withColumns({f"exp_{h}": 1 - F.exp(-rate * h) for h in horizons})


def rule_labels(features: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    return features.withColumns(
        {f"rule_{h}": (F.col("last_seen") <= h - 1).cast("int") for h in horizons}
    )


def ensemble_probability(
    df: DataFrame, weights: Mapping[str, float] = WEIGHTS, horizons: Sequence[int] = HORIZONS
) -> DataFrame:
    """Weighted sum of the model columns ``<model>_<h>``; a null part gives a null sum."""

    def total(h: int) -> Column:
        parts = [F.col(f"{model}_{h}") * weight for model, weight in weights.items()]
        out = parts[0]
        for part in parts[1:]:
            out = out + part
        return out

    return df.withColumns({f"ensemble_{h}": total(h) for h in horizons})


def confidence_text(probability: Column, frequency: Column) -> Column:
    """A null probability fails every comparison and falls through to low confidence."""
    return (
        F.when((probability >= 0.6) & (frequency >= 2), "Highly likely")
        .when((probability >= 0.07) & (frequency >= 1), "Possibly active")
        .otherwise("Low confidence")
    )


def confidence_band(df: DataFrame, horizon: int, probability: str | None = None) -> DataFrame:
    band = confidence_text(F.col(probability or f"ensemble_{horizon}"), F.col(f"freq_{horizon}"))
    return df.withColumn(
        f"confidence_{horizon}", F.concat(F.lit(f"{horizon}-Day: "), band)
    )


def forecast_report(
    df: DataFrame, panel: DataFrame, horizons: Sequence[int] = HORIZONS,
    keys: Sequence[str] = ("OpDiv", "indicator"), last_day: str | None = None,
) -> DataFrame:
    """The published columns, with whether the indicator was seen on the panel's last day, which is
    looked up unless it is given."""
    day = panel.agg(F.max("date")).scalar() if last_day is None else F.lit(last_day).cast("date")
    today = panel.where(F.col("date") == day).groupBy(*keys).agg(
        F.max("seen").alias("Observed Today")
    )
    joined = df.join(today, list(keys), "left")
    return joined.select(
        F.col("indicator").alias("Indicator"),
        "Observed Today",
        *[F.col(f"freq_{d}").alias(f"Frequency ({d}d)") for d in (1, 7, 30, 45)],
        *[
            column
            for h in horizons
            for column in (
                percent_text(F.col(f"ensemble_{h}")).alias(f"Probability: {h}-Day"),
                F.col(f"confidence_{h}").alias(f"Confidence: {h}-Day"),
            )
        ],
        F.col("OpDiv").alias("Partner"),
    )


def forecast_log(
    report: DataFrame, actuals: DataFrame, forecast_date: str, as_of: str,
    horizons: Sequence[int] = (7, 14, 30, 45),
) -> DataFrame:
    """One row per indicator and horizon with the check date and what happened by ``as_of``."""
    day = F.lit(forecast_date).cast("date")
    entries = F.array(
        *[
            F.struct(
                F.lit(f"{h}-Day").alias("type"),
                F.col(f"`Confidence: {h}-Day`").alias("confidence"),
                F.date_add(day, h).alias("check"),
            )
            for h in horizons
        ]
    )
    rows = report.select("Partner", "Indicator", F.explode(entries).alias("e")).select(
        "Partner",
        "Indicator",
        day.alias("Forecast Date"),
        F.col("e.type").alias("Forecast Type"),
        F.col("e.confidence").alias("Confidence"),
        F.col("e.check").alias("Forecasted Check Date"),
    )
    seen = actuals.groupBy(
        F.col("OpDiv").alias("Partner"), F.col("indicator").alias("Indicator"),
        F.col("date").alias("Forecasted Check Date"),
    ).agg(F.max("seen").alias("_seen"))
    outcome = (
        F.when(F.col("Forecasted Check Date") > F.lit(as_of).cast("date"), "Pending")
        .when(F.col("_seen") == 1, "Seen")
        .when(F.col("_seen") == 0, "Not Seen")
        .otherwise("Unknown")
    )
    keys = ["Partner", "Indicator", "Forecasted Check Date"]
    return rows.join(seen, keys, "left").withColumn("Outcome", outcome).drop("_seen")


def _norm(value: Column) -> Column:
    return F.lower(F.trim(value))


def resolve_outcomes(log: DataFrame, reports: DataFrame) -> DataFrame:
    """Settle forecasts from the daily reports of their check day.

    Seen when a report row of the same partner and indicator has ``Observed Today`` = 1, else Not
    Seen; rows whose check day has no report at all stay as they are.
    """
    log = log.withColumn("Confidence", F.trim(F.regexp_replace("Confidence", r"^\d+-Day:\s*", "")))
    keys = [F.col(c).alias(f"_{c}") for c in ("p", "i", "d")]
    seen = reports.select(
        _norm(F.col("Partner")).alias("p"), _norm(F.col("Indicator")).alias("i"),
        F.col("FileDate").alias("d"), "`Observed Today`",
    ).groupBy(*keys).agg(F.max("Observed Today").alias("_seen"))
    # one row per report day
    days = reports.select(F.col("FileDate").alias("Forecasted Check Date")).distinct()
    days = small(days.withColumn("_reported", F.lit(True)))
    matched = log.join(
        seen,
        (_norm(F.col("Partner")) == F.col("_p"))
        & (_norm(F.col("Indicator")) == F.col("_i"))
        & (F.col("Forecasted Check Date") == F.col("_d")),
        "left",
    ).join(days, "Forecasted Check Date", "left")
    settled = F.when(F.col("_seen") == 1, "Seen").when(F.col("_reported"), "Not Seen")
    return matched.withColumn("Outcome", settled.otherwise(F.col("Outcome"))).drop(
        "_p", "_i", "_d", "_seen", "_reported"
    )


def forecast_feedback(log: DataFrame, master: DataFrame) -> DataFrame:
    """Add settled rows to the training master, the log's row winning per forecast."""
    keys = ["Partner", "Indicator", "Forecast Date", "Forecast Type", "Confidence"]
    settled = log.where(F.col("Outcome").isin("Seen", "Not Seen")).withColumn("_new", F.lit(1))
    both = settled.unionByName(master.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    newest = W.partitionBy(*keys).orderBy(F.col("_new").desc(), "Outcome")
    return both.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn", "_new")
