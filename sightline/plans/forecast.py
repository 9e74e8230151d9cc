"""The forecast job: from sightings to a report."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.forecast import confidence_band, ensemble_probability, exp_hazard, forecast_report
from ..operators.models import FEATURES, boosted_scorer, equal_parts, logistic_scorer, survival_scorer
from ..operators.runs import recurrence_at, recurrence_features, run_length_panel
from ..session import pin


def likely_again(obs: DataFrame, as_of: str, horizon: int = 7, n: int = 100) -> DataFrame:
    """Top indicators by chance of a sighting within ``horizon`` days.

    The partner is a key, not a loop; all features come from one (partner, indicator) exchange.
    """
    features = recurrence_features(run_length_panel(obs, as_of), as_of)
    scored = exp_hazard(features, (horizon,))
    scored = confidence_band(scored, horizon, f"exp_{horizon}")
    return (
        scored.select(
            "OpDiv", "indicator", "last_seen", f"freq_{horizon}", "freq_30",
            F.round(f"exp_{horizon}", 6).alias("probability"),
            F.col(f"confidence_{horizon}").alias("confidence"),
        )
        .orderBy(F.col("probability").desc(), "OpDiv", "indicator")
        .limit(n)
    )


def training_frame(obs: DataFrame, as_of: str, horizon: int, keys=("OpDiv", "indicator")) -> DataFrame:
    """Features at ``as_of − horizon`` with ``label`` = seen in the days after that.

    The label lies strictly after everything the features have seen.
    """
    cut = (date.fromisoformat(as_of) - timedelta(days=horizon)).isoformat()
    features = recurrence_features(run_length_panel(obs, cut, keys=keys), cut, keys=keys)
    later = (
        obs.where((F.col("obs_date") > cut) & (F.col("obs_date") <= as_of) & (F.col("observations") > 0))
        .select(*keys)
        .distinct()
        .withColumn("label", F.lit(1))
    )
    return features.join(later, list(keys), "left").withColumn("label", F.coalesce("label", F.lit(0)))


def forecast_job(
    obs: DataFrame, as_of: str, horizons=(1, 7, 14, 30, 45), mode: str = "out_of_sample"
) -> DataFrame:
    """The daily report: four models per horizon, ensemble, confidence bands.

    ``mode='in_sample'`` fits on labels taken from the same window as the features.
    """
    keys = ("OpDiv", "indicator")
    last = date.fromisoformat(as_of)
    cuts = {h: as_of if mode == "in_sample" else (last - timedelta(days=h)).isoformat() for h in horizons}
    # one pass over the sightings gives the features of today and those of every horizon's training day
    series = pin(recurrence_at(run_length_panel(obs, as_of), (as_of, *cuts.values())))
    features = series.select(*keys, f"at_{as_of}.*").drop("label")

    def training(h: int) -> DataFrame:
        at = F.col(f"at_{cuts[h]}")
        # a null key is equal to no later sighting
        later = F.when(F.col("OpDiv").isNotNull() & F.col("indicator").isNotNull(), at["label"]).otherwise(F.lit(0))
        label = at[f"label_{max(h, 7)}"] if mode == "in_sample" else later
        rows = series.where(at.isNotNull()).select(*keys, *[at[c].alias(c) for c in FEATURES], label.alias("label"))
        return pin(equal_parts(rows, keys).drop(*keys))

    def fits(h: int, train: DataFrame) -> list[Callable]:
        return [
            lambda: logistic_scorer(train, label="label", out=f"logistic_{h}"),
            lambda: boosted_scorer(train, label="label", out=f"boosted_{h}"),
            lambda: survival_scorer(train, event="label", times=(h,)),
        ]

    scored = exp_hazard(features, horizons)
    # the fits know nothing of each other, so their many short jobs share the cluster
    with ThreadPoolExecutor(max_workers=max(1, 3 * len(horizons))) as pool:
        trains = pool.map(training, horizons)
        running = [pool.submit(fit) for h, train in zip(horizons, trains) for fit in fits(h, train)]
        for scorer in running:
            scored = scorer.result()(scored)
    scored = ensemble_probability(scored, horizons=horizons)
    for h in horizons:
        scored = confidence_band(scored, h)
    today = features.select(*keys, (F.col("last_seen") == 0).cast("int").alias("seen"), F.lit(as_of).cast("date").alias("date"))
    return forecast_report(scored, today, horizons, last_day=as_of)
