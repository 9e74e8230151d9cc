"""Dense daily panels and the window features over them.

A panel has one row per (partner, indicator, day).  Sightings are summed per day before any
window is opened, so the hottest indicator has one row per day like every other, and all windows
share the (partner, indicator) partitioning of the panel: one exchange feeds them all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec
from pyspark.sql import functions as F

from ..session import small
from .ordering import add_row_number, exact_quantiles

SERIES = ("OpDiv", "indicator")
HORIZONS = (1, 7, 14, 30, 45)


def _ordered(keys: Sequence[str], order: str = "date") -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order)


def _last_rows(keys: Sequence[str], n: int, order: str = "date") -> WindowSpec:
    return _ordered(keys, order).rowsBetween(1 - n, 0)


def dense_panel(
    obs: DataFrame, as_of: str, min_seen: int = 2, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Zero-filled daily panel from the partner's first day to ``as_of``.

    Indicators seen on fewer than ``min_seen`` days are dropped before any row is generated.
    Each sighting day is then stretched to the day before the next one, which needs neither a
    cross product nor a join back to the facts.
    """
    days = obs.groupBy(*keys, F.col("obs_date").alias("date")).agg(
        F.sum("observations").alias("observations")
    )
    span = small(obs.groupBy("OpDiv").agg(F.min("obs_date").alias("_first")))
    series, everything = _ordered(keys), W.partitionBy(*keys)
    as_of_day = F.lit(as_of).cast("date")
    start = F.when(F.row_number().over(series) == 1, F.col("_first")).otherwise(F.col("date"))
    stop = F.coalesce(F.date_sub(F.lead("date").over(series), 1), as_of_day)
    stretched = (
        days.join(span, "OpDiv")
        .withColumn(
            "total_seen",
            F.sum(F.when(F.col("observations") > 0, 1).otherwise(0)).over(everything),
        )
        .withColumn("_days", F.sequence(start, stop))
        .where(F.col("total_seen") >= min_seen)
        .withColumn("_day", F.explode("_days"))
    )
    on_day = F.when(F.col("_day") == F.col("date"), F.col("observations")).otherwise(0)
    panel = stretched.select(
        *keys, F.col("_day").alias("date"), on_day.cast("long").alias("observations"), "total_seen"
    )
    return panel.select(
        *keys,
        "date",
        "observations",
        F.weekday("date").alias("dayofweek"),
        (F.weekday("date") >= 5).alias("is_weekend"),
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.when(F.col("observations") > 0, 1).otherwise(0).alias("seen"),
        "total_seen",
    )


def cross_panel(obs: DataFrame, as_of: str, min_seen: int = 1) -> DataFrame:
    """Panel that keeps the reporting user in the key.

    Only (user, indicator) pairs that were ever reported get a series; all other pairs would be
    all zeros, and writing them out is a product of users and indicators.
    """
    return dense_panel(obs, as_of, min_seen, ("OpDiv", "API_UserName", "indicator"))


def recurrence_features(
    panel: DataFrame, horizons: Sequence[int] = HORIZONS, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Per series: ``last_seen``, ``freq_k``, ``avg_gap``, ``burstiness``, ``label_k``."""
    series = _ordered(keys)
    seen = F.col("seen") == 1
    indexed = panel.withColumn("_i", F.row_number().over(series) - 1).withColumn(
        "_n", F.count("*").over(W.partitionBy(*keys))
    )
    before = F.last(F.when(seen, F.col("_i")), ignorenulls=True).over(
        series.rowsBetween(W.unboundedPreceding, -1)
    )
    indexed = indexed.withColumn("_gap", F.when(seen, F.col("_i") - before))
    out = indexed.groupBy(*keys).agg(
        F.first("_n").alias("_n"),
        F.max(F.when(seen, F.col("_i"))).alias("_last"),
        *[
            F.sum(F.when(F.col("_i") >= F.col("_n") - k, F.col("seen")).otherwise(0)).alias(f"freq_{k}")
            for k in horizons
        ],
        F.avg("_gap").alias("_mean"),
        F.stddev_pop("_gap").alias("_std"),
        F.count("_gap").alias("_gaps"),
    )
    bursty = (F.col("_std") - F.col("_mean")) / (F.col("_std") + F.col("_mean"))
    return out.select(
        *keys,
        F.coalesce(F.col("_n") - 1 - F.col("_last"), F.col("_n")).alias("last_seen"),
        *[f"freq_{k}" for k in horizons],
        F.coalesce(F.col("_mean"), F.col("_n").cast("double")).alias("avg_gap"),
        F.when(F.col("_gaps") > 1, bursty).otherwise(F.lit(0.0)).alias("burstiness"),
        *[(F.col(f"freq_{k}") > 0).cast("int").alias(f"label_{k}") for k in horizons if k > 1],
    )


def cumulative_seen(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    running = _ordered(keys).rowsBetween(W.unboundedPreceding, 0)
    return panel.withColumn("cumulative_seen", F.sum("seen").over(running))


def days_since_last_seen(
    panel: DataFrame, strict: bool = False, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Days since the last sighting; today's counts unless ``strict``.

    The strict form fills days before the first sighting with 0; the other leaves them null.
    """
    frame = _ordered(keys).rowsBetween(W.unboundedPreceding, -1 if strict else 0)
    last = F.last(F.when(F.col("seen") == 1, F.col("date")), ignorenulls=True).over(frame)
    days = F.datediff("date", last)
    return panel.withColumn("days_since_last_seen", F.coalesce(days, F.lit(0)) if strict else days)


def seen_streak(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Length of the current run of seen days, 0 on an unseen day."""
    series = _ordered(keys)
    island = F.sum(F.when(F.col("seen") == 0, 1).otherwise(0)).over(
        series.rowsBetween(W.unboundedPreceding, 0)
    )
    run = W.partitionBy(*keys, "_island").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    return (
        panel.withColumn("_island", island)
        .withColumn("seen_streak", F.sum("seen").over(run))
        .drop("_island")
    )


def streak_summary(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Longest seen and unseen runs, sighting intervals and ratios per series."""
    series = _ordered(keys)
    changed = F.when(F.lag("seen").over(series) == F.col("seen"), 0).otherwise(1)
    seen = F.col("seen") == 1
    before = F.last(F.when(seen, F.col("_i")), ignorenulls=True).over(
        series.rowsBetween(W.unboundedPreceding, -1)
    )
    rows = (
        panel.withColumn("_i", F.row_number().over(series) - 1)
        .withColumn("_gap", F.when(seen, F.col("_i") - before))
        .withColumn("_changed", changed)
        .withColumn("_run", F.sum("_changed").over(series.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_len", F.count("*").over(W.partitionBy(*keys, "_run")))
    )
    return rows.groupBy(*keys).agg(
        F.count("*").alias("total_days"),
        F.sum("seen").alias("total_seen"),
        F.avg("seen").alias("seen_ratio"),
        F.stddev_pop("seen").alias("seen_std"),
        F.coalesce(F.max(F.when(seen, F.col("_len"))), F.lit(0)).alias("max_seen_streak"),
        F.coalesce(F.max(F.when(~seen, F.col("_len"))), F.lit(0)).alias("max_unseen_streak"),
        F.avg("_gap").alias("mean_seen_interval"),
        F.stddev_pop("_gap").alias("std_seen_interval"),
        (F.count("*") - 1 - F.max(F.when(seen, F.col("_i")))).alias("days_since_last_seen"),
    )


def rolling_stats(
    panel: DataFrame,
    col: str,
    windows: Sequence[int] = (3, 7, 14, 30),
    min_periods: int | None = 1,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Rolling mean, std, sum, min and max; ``min_periods=None`` asks for full windows."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}
    out = {}
    for n in windows:
        frame = _last_rows(keys, n)
        enough = F.count(col).over(frame) >= (n if min_periods is None else min_periods)
        for name, stat in stats.items():
            out[f"{col}_{name}_{n}"] = F.when(enough, stat(col).over(frame))
    return panel.withColumns(out)


def rolling_quantile_flags(
    panel: DataFrame, n: int = 14, keys: Sequence[str] = SERIES
) -> DataFrame:
    """High activity on an unseen day and low activity on a seen day, with rolling shares.

    The percentile frame never holds more than ``n`` days.
    """
    frame = _last_rows(keys, n)
    high = F.percentile("observations", F.lit(0.75)).over(frame)
    low = F.percentile("observations", F.lit(0.25)).over(frame)
    flagged = panel.withColumns(
        {
            "high_activity_not_seen": (
                (F.col("observations") >= high) & (F.col("seen") == 0)
            ).cast("int"),
            "low_activity_seen": ((F.col("observations") <= low) & (F.col("seen") == 1)).cast("int"),
        }
    )
    return flagged.withColumns(
        {
            f"high_activity_not_seen_ratio_{n}d": F.avg("high_activity_not_seen").over(frame),
            f"low_activity_seen_ratio_{n}d": F.avg("low_activity_seen").over(frame),
        }
    )


def activity_mismatch(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The same flags against the quartiles of the whole series (one value per day)."""
    whole = W.partitionBy(*keys)
    rows = panel.withColumns(
        {
            "_high": F.percentile("observations", F.lit(0.75)).over(whole),
            "_low": F.percentile("observations", F.lit(0.25)).over(whole),
        }
    )
    not_seen = ((F.col("observations") >= F.col("_high")) & (F.col("seen") == 0)).cast("int")
    seen = ((F.col("observations") <= F.col("_low")) & (F.col("seen") == 1)).cast("int")
    return rows.groupBy(*keys).agg(
        F.sum(not_seen).alias("high_activity_not_seen_count"),
        F.avg(not_seen).alias("high_activity_not_seen_ratio"),
        F.sum(seen).alias("low_activity_seen_count"),
        F.avg(seen).alias("low_activity_seen_ratio"),
    )


def trend_ratios(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Change of the seen ratio, activity spike, sudden drop and volatility; nulls become 0."""
    series = _ordered(keys)

    def mean(col: str, n: int) -> Column:
        return F.avg(col).over(_last_rows(keys, n))

    rows = seen_streak(panel, keys).withColumns(
        {
            "_ratio": mean("seen", 14),
            "_std": F.stddev_samp("seen").over(_last_rows(keys, 14)),
            "_obs14": mean("observations", 14),
            "_obs7": mean("observations", 7),
        }
    )
    features = {
        "seen_ratio_diff": F.col("_ratio") - F.lag("_ratio", 7).over(series),
        "obs_ratio_spike": F.col("_obs14") / (F.col("_obs7") + F.lit(1e-6)),
        "seen_streak_prev": F.lag("seen_streak").over(series),
        "volatility_ratio": F.col("_std") / (F.col("_ratio") + F.lit(1e-5)),
    }
    rows = rows.withColumns({k: F.coalesce(v, F.lit(0)) for k, v in features.items()})
    dropped = (F.col("seen_streak_prev") >= 5) & (F.col("seen_streak") == 0)
    return rows.withColumn("recent_drop_flag", dropped.cast("int")).drop(
        "_ratio", "_std", "_obs14", "_obs7"
    )


def temporal_features(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """All daily activity features of a panel, on one partitioning; nulls become 0."""
    rows = days_since_last_seen(cumulative_seen(panel, keys), keys=keys)
    rows = rolling_quantile_flags(trend_ratios(rows, keys), 14, keys)

    def over(fn, col: str, n: int) -> Column:
        return fn(col).over(_last_rows(keys, n))

    rows = rows.withColumns(
        {
            "rolling_seen_ratio_14d": over(F.avg, "seen", 14),
            "rolling_seen_std_14d": over(F.stddev_samp, "seen", 14),
            "rolling_seen_ratio_7d": over(F.avg, "seen", 7),
            "rolling_obs_14d": over(F.avg, "observations", 14),
            "rolling_obs_7d": over(F.avg, "observations", 7),
        }
    )
    return rows.na.fill(0, ["days_since_last_seen", "rolling_seen_std_14d"])


def lag_features(panel: DataFrame, cols: Sequence[str], n: int, keys: Sequence[str] = SERIES) -> DataFrame:
    series = _ordered(keys)
    return panel.withColumns(
        {f"{c}_lag_{k}": F.lag(c, k).over(series) for c in cols for k in range(1, n + 1)}
    )


def calendar_features(panel: DataFrame, date: str = "date") -> DataFrame:
    return panel.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
            "dayofweek": F.weekday(date),
            "dayofyear": F.dayofyear(date),
            "is_weekend": F.weekday(date) >= 5,
        }
    )


def lead_target(panel: DataFrame, col: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """Next day's value as ``target``."""
    return panel.withColumn("target", F.lead(col).over(_ordered(keys)))


def sequence_windows(
    panel: DataFrame, cols: Sequence[str], length: int, target: str, horizon: int = 1,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Sliding input sequences of ``length`` days with the next ``horizon`` targets."""
    series = _ordered(keys)
    past, future = series.rowsBetween(1 - length, 0), series.rowsBetween(1, horizon)
    rows = panel.select(
        *keys,
        "date",
        *[F.collect_list(c).over(past).alias(f"{c}_seq") for c in cols],
        F.collect_list(target).over(future).alias("target_seq"),
    )
    return rows.where(
        (F.size(f"{cols[0]}_seq") == length) & (F.size("target_seq") == horizon)
    )


def ewm(
    panel: DataFrame, col: str, span: int = 3, out: str | None = None, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Exponential mean without bias adjustment: ``y = y' + a·(x − y')`` with ``a = 2/(span+1)``.

    Each day takes its value from a pair (a, b), y = a·y' + b, of the day before.  Pairs are composed
    with those 1, 2, 4, … days earlier, by windows in the order of the panel that need no further
    exchange or sort, until what is left of the weight a is below double precision; so a series of n
    days takes the same few passes over n rows, whatever n is.
    """
    alpha = 2.0 / (span + 1)
    out = out or f"{col}_ewm_{span}"
    series, x = _ordered(keys), F.col(col).cast("double")
    first = F.row_number().over(series) == 1
    rows = panel.withColumns({
        "_a": F.when(first, F.lit(0.0)).otherwise(F.lit(1 - alpha)), "_b": F.when(first, x).otherwise(F.lit(alpha) * x)})
    reach = 1
    while alpha < 1 and reach * math.log(1 - alpha) > math.log(1e-18):
        earlier_a, earlier_b = F.lag("_a", reach).over(series), F.lag("_b", reach).over(series)
        whole = earlier_a.isNull()  # the pair reaches the first day already
        rows = rows.withColumns({
            "_a": F.when(whole, F.col("_a")).otherwise(F.col("_a") * earlier_a),
            "_b": F.when(whole, F.col("_b")).otherwise(F.col("_b") + F.col("_a") * earlier_b)})
        reach *= 2
    return rows.withColumn(out, F.col("_b")).drop("_a", "_b")


def minmax_scale(
    df: DataFrame, col: str, by: Sequence[str] | None = None, out: str | None = None
) -> DataFrame:
    """``(x − min)/(max − min)`` over the whole frame or per key; a zero range counts as 1."""
    out = out or f"{col}_scaled"
    if by:
        low, high = F.min(col).over(W.partitionBy(*by)), F.max(col).over(W.partitionBy(*by))
    else:
        low = df.agg(F.min(col)).scalar()
        high = df.agg(F.max(col)).scalar()
    width = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    return df.withColumn(out, (F.col(col) - low) / width)


def difference(panel: DataFrame, col: str, lag: int = 1, keys: Sequence[str] = SERIES) -> DataFrame:
    return panel.withColumn(
        f"{col}_diff_{lag}", F.col(col) - F.lag(col, lag).over(_ordered(keys))
    )


def seasonal_means(
    panel: DataFrame, col: str, period: int = 7, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Additive decomposition: centred trend, seasonal mean by phase, residual.

    For an even period the trend takes one value more, the first and the last at half weight.
    """
    half = period // 2
    series = _ordered(keys)
    frame = series.rowsBetween(-half, half)
    total = F.sum(col).over(frame)
    if period % 2 == 0:
        total = total - (F.lag(col, half).over(series) + F.lead(col, half).over(series)) / 2
    trend = F.when(F.count(col).over(frame) == 2 * half + 1, total / period)
    phase = W.partitionBy(*keys, "phase")
    rows = (
        panel.withColumn("phase", F.pmod(F.row_number().over(series) - 1, F.lit(period)))
        .withColumn("trend", trend)
        .withColumn("_detrended", F.col(col) - F.col("trend"))
        .withColumn("_phase_mean", F.avg("_detrended").over(phase))
        .withColumn("_first", F.row_number().over(phase.orderBy("date")) == 1)
    )
    centre = F.avg(F.when(F.col("_first"), F.col("_phase_mean"))).over(W.partitionBy(*keys))
    return (
        rows.withColumn("seasonal", F.col("_phase_mean") - centre)
        .withColumn("residual", F.col("_detrended") - F.col("seasonal"))
        .drop("_detrended", "_phase_mean", "_first")
    )


def autocorrelation(
    panel: DataFrame, col: str, max_lag: int = 14, level: float = 0.5, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Autocorrelation per series and lag, and the first lag above ``level``.

    Lags come from the ordered window, so no self-join is needed.
    """
    series = _ordered(keys)
    centred = panel.withColumn("_x", F.col(col) - F.avg(col).over(W.partitionBy(*keys)))
    lags = range(1, max_lag + 1)
    rows = centred.withColumns(
        {f"_p{k}": F.col("_x") * F.lag("_x", k).over(series) for k in lags}
    )
    sums = rows.groupBy(*keys).agg(
        F.sum(F.col("_x") * F.col("_x")).alias("_var"),
        *[F.sum(f"_p{k}").alias(f"_p{k}") for k in lags],
    )
    # a constant series leaves only rounding noise in the variance
    scaled = [F.when(F.col("_var") > 1e-12, F.col(f"_p{k}") / F.col("_var")) for k in lags]
    entries = F.array(*[F.struct(F.lit(k).alias("lag"), v.alias("acf")) for k, v in zip(lags, scaled)])
    first = F.coalesce(*[F.when(v > level, F.lit(k)) for k, v in zip(lags, scaled)])
    return sums.select(*keys, F.explode(entries).alias("e"), first.alias("first_lag_above")).select(
        *keys, "e.lag", "e.acf", "first_lag_above"
    )


def predictability(
    panel: DataFrame, min_seen: int = 5, min_rate: float = 0.10, min_streak: int = 3,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    stats = seen_streak(panel, keys).groupBy(*keys).agg(
        F.count("*").alias("total_days"),
        F.sum("seen").alias("total_seen"),
        F.stddev_samp("seen").alias("seen_days_std"),
        F.max("seen_streak").alias("max_seen_streak"),
        F.avg("seen").alias("seen_rate"),
    )
    return stats.withColumn(
        "is_predictable",
        (F.col("total_seen") >= min_seen)
        & (F.col("seen_rate") >= min_rate)
        & (F.col("max_seen_streak") >= min_streak),
    )


def activity_scores(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Visibility score and unseen risk per series."""
    features = streak_summary(panel, keys).join(activity_mismatch(panel, keys), list(keys))
    # fixed weights
    seen_score = (
        F.col("total_seen") * 0.3
        + F.col("seen_ratio") * 50
        + F.col("max_seen_streak") * 0.2
        - F.col("days_since_last_seen") * 0.1
    )
    unseen_risk = (
        F.col("high_activity_not_seen_ratio") * 100
        + F.col("max_unseen_streak") * 0.2
        + F.col("days_since_last_seen") * 0.5
    )
    return features.withColumns({"seen_score": seen_score, "unseen_risk": unseen_risk})


def score_class_means(scores: DataFrame, by: str) -> DataFrame:
    """Mean visibility score and risk per class."""
    return scores.groupBy(by).agg(
        F.avg("seen_score").alias("seen_score"), F.avg("unseen_risk").alias("unseen_risk")
    )


def forward_fill(df: DataFrame, col: str, order: str, keys: Sequence[str] = SERIES) -> DataFrame:
    frame = _ordered(keys, order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(frame))


def retain_latest_days(df: DataFrame, n: int, date: str = "date") -> DataFrame:
    """Rows of the ``n`` latest distinct dates."""
    latest = df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)
    # at most n rows
    return df.join(F.broadcast(latest), date, "left_semi")


def latest_row(panel: DataFrame, before: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """Last row per series on or before a cut-off day."""
    newest = W.partitionBy(*keys).orderBy(F.col("date").desc())
    return (
        panel.where(F.col("date") <= F.lit(before).cast("date"))
        .withColumn("_rn", F.row_number().over(newest))
        .where("_rn = 1")
        .drop("_rn")
    )


def rank_narrow(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Only the ordering columns (column, descending) with their ``_rank``."""
    columns = [F.col(c).desc() if desc else F.col(c).asc() for c, desc in order]
    return add_row_number(df.select(*[c for c, _ in order]), columns, "_rank")


def first_rows(ranked: DataFrame, order: Sequence[tuple[str, bool]], rank: Column) -> Column:
    """Condition that holds for the first ``rank`` rows of the frame that ``ranked`` was made of.

    Only the ordering columns are sorted; the wide rows are then filtered where they are.
    """
    names = [c for c, _ in order]
    edge = ranked.where(F.col("_rank") == rank).select(F.struct(*names)).scalar()
    inside, equal = F.lit(False), F.lit(True)
    for name, desc in order:
        ahead = F.col(name) > edge[name] if desc else F.col(name) < edge[name]
        inside = inside | (equal & ahead)
        equal = equal & (F.col(name) == edge[name])
    # no such rank (no rows asked for): nothing is inside
    return F.coalesce(inside | equal, F.lit(False))


def top_fraction(df: DataFrame, col: str, p: float, key: str = "indicator") -> DataFrame:
    """The top ``ceil(p·n)`` rows by ``col``, ties broken by the unique ``key``."""
    rows = df.where(F.col(col).isNotNull())
    rank = F.ceil(rows.agg(F.count("*")).scalar() * F.lit(p))
    order = [(col, True), (key, False)]
    return rows.where(first_rows(rank_narrow(rows, order), order, rank))


def quantile_bands(
    df: DataFrame, col: str, qs: Sequence[float] = (0, 0.4, 0.7, 0.9, 1.0),
    labels: Sequence[str] = ("Low", "Moderate", "High", "Critical"), out: str = "band",
) -> DataFrame:
    """Label by quantile band; right-closed, lowest value included, collapsed bands dropped."""
    quantiles = exact_quantiles(df, col, qs)
    edges = quantiles.select(F.array(*[f"q{i}" for i in range(len(qs))])).scalar()
    bands = [
        F.when((F.col(col) <= edges[i + 1]) & (edges[i + 1] > edges[0]), F.lit(label))
        for i, label in enumerate(labels)
    ]
    return df.withColumn(out, F.coalesce(*bands))


