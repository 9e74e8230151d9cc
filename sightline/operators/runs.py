"""The run-length panel: one row per sighting day, standing for the days up to the next one.

What the dense panel answers by windows over every day, intervals answer by arithmetic on the days
of the sightings alone.  Windows are opened over sighting days only; operators whose result has a row
for every day stretch the rows as their last step, so no day without a sighting is ever exchanged or
sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import small
from .timeseries import HORIZONS, SERIES

LOOK_BACK = 21  # days that the daily features look back, the day itself included


def run_length_panel(
    obs: DataFrame, as_of: str, min_seen: int = 2, keys: Sequence[str] = SERIES, first_day: bool = False
) -> DataFrame:
    """One row per (series, sighting day) up to ``as_of``.

    ``gap`` counts the days since the sighting before (null at the first), ``ahead`` the days that the
    row stands for, up to the day before the next sighting or to ``as_of``; ``cumulative_seen`` counts
    the sightings so far, ``streak`` the consecutive ones that end here; ``total_seen`` those of the
    series, which is dropped below ``min_seen`` (at least 1).  ``first_day`` adds ``first``, the
    partner's first day, where the dense panel begins; partners are few, so their table is counted
    and then broadcast.  A day whose sightings add up to nothing is a day without one.
    """
    if min_seen < 1:
        raise ValueError("a series without a sighting has no row here; use dense_panel")
    day = F.lit(as_of).cast("date")
    past = obs.where(F.col("obs_date") <= day)
    days = past.groupBy(*keys, F.col("obs_date").alias("date")).agg(F.sum("observations").cast("long").alias("observations"))
    days = days.where("observations > 0")
    if first_day:
        days = days.join(small(past.groupBy("OpDiv").agg(F.min("obs_date").alias("first"))), "OpDiv")
    series = W.partitionBy(*keys).orderBy("date")
    rows = days.withColumns({
        "gap": F.datediff("date", F.lag("date").over(series)),
        "ahead": F.datediff(F.coalesce(F.lead("date").over(series), F.date_add(day, 1)), F.col("date")),
        "cumulative_seen": F.row_number().over(series).cast("long"),
        "total_seen": F.count(F.lit(1)).over(W.partitionBy(*keys)),
    }).where(F.col("total_seen") >= min_seen)
    opened = F.last(F.when(F.coalesce(F.col("gap"), F.lit(2)) > 1, F.col("cumulative_seen")), ignorenulls=True)
    so_far = series.rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("streak", F.col("cumulative_seen") - opened.over(so_far) + 1)


def recurrence_features(
    runs: DataFrame, as_of: str, horizons: Sequence[int] = HORIZONS, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Per series: ``last_seen``, ``freq_k``, ``avg_gap``, ``burstiness``, ``label_k``.

    Equal to the features of the dense panel.  A series of one sighting has the length of the panel
    as its gap, so panels with such series need ``first``.
    """
    day = F.lit(as_of).cast("date")
    length = F.datediff(day, F.min("first")) + 1 if "first" in runs.columns else F.lit(None).cast("int")
    out = runs.groupBy(*keys).agg(*_totals(day, horizons, F.col), length.alias("_n"))
    return out.select(*keys, *_features(horizons))


def _totals(day: Column, horizons: Sequence[int], seen: Callable[[str], Column], at: str = "") -> list[Column]:
    """Aggregates behind the features on ``day``; ``seen`` gives a column where the sighting counts, else null."""
    out = {
        "last_seen": F.datediff(day, F.max(seen("date"))).cast("long"),
        **{f"freq_{k}": F.count_if(seen("date") > F.date_sub(day, k)) for k in horizons},
        "_mean": F.avg(seen("gap")), "_std": F.stddev_pop(seen("gap")), "_gaps": F.count(seen("gap")),
    }
    return [value.alias(f"{at}{name}") for name, value in out.items()]


def _features(horizons: Sequence[int], at: str = "", length: Column | None = None) -> list[Column]:
    mean, std, gaps = (F.col(f"{at}{name}") for name in ("_mean", "_std", "_gaps"))
    length = F.col("_n") if length is None else length
    return [
        *[F.col(f"{at}{name}").alias(name) for name in ("last_seen", *[f"freq_{k}" for k in horizons])],
        F.coalesce(mean, length.cast("double")).alias("avg_gap"),
        F.when(gaps > 1, (std - mean) / (std + mean)).otherwise(F.lit(0.0)).alias("burstiness"),
        *[(F.col(f"{at}freq_{k}") > 0).cast("int").alias(f"label_{k}") for k in horizons if k > 1],
    ]


def recurrence_at(
    runs: DataFrame, cuts: Sequence[str], min_seen: int = 2, horizons: Sequence[int] = HORIZONS, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Per series and day of ``cuts`` a struct ``at_<day>``, all from one pass over the sightings of ``runs``.

    It holds ``recurrence_features`` of what was known on that day and ``label``, whether a sighting came
    later.  Null for a series of fewer than ``min_seen`` sightings by then.  A gap looks back only, so it
    is the same on every later day.
    """
    totals, structs = [], []
    for n, cut in enumerate(dict.fromkeys(cuts)):
        day, at = F.lit(cut).cast("date"), f"_{n}"
        totals += _totals(day, horizons, lambda c, day=day: F.when(F.col("date") <= day, F.col(c)), at)
        totals += [F.count_if(F.col("date") <= day).alias(f"{at}_seen"), F.count_if(F.col("date") > day).alias(f"{at}_later")]
        later = (F.col(f"{at}_later") > 0).cast("int").alias("label")
        row = F.struct(*_features(horizons, at, F.lit(None)), later)
        structs.append(F.when(F.col(f"{at}_seen") >= min_seen, row).alias(f"at_{cut}"))
    return runs.groupBy(*keys).agg(*totals).select(*keys, *structs)


def seen_on(runs: DataFrame, as_of: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """(series, date, seen): whether each series was sighted on ``as_of``."""
    day = F.lit(as_of).cast("date")
    return runs.groupBy(*keys).agg((F.max("date") == day).cast("int").alias("seen")).withColumn("date", day)


def streak_summary(runs: DataFrame, as_of: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """Longest seen and unseen runs, sighting intervals and ratios per series; needs ``first``."""
    day = F.lit(as_of).cast("date")
    unseen = F.greatest(F.max(F.col("gap") - 1), F.datediff(F.min("date"), F.min("first")), F.datediff(day, F.max("date")))
    out = runs.groupBy(*keys).agg(
        (F.datediff(day, F.min("first")) + 1).cast("long").alias("total_days"),
        F.count(F.lit(1)).alias("total_seen"),
        F.max("streak").alias("max_seen_streak"),
        unseen.cast("long").alias("max_unseen_streak"),
        F.avg("gap").alias("mean_seen_interval"), F.stddev_pop("gap").alias("std_seen_interval"),
        F.datediff(day, F.max("date")).cast("long").alias("days_since_last_seen"),
    )
    ratio = F.col("total_seen") / F.col("total_days")
    return out.withColumns({"seen_ratio": ratio, "seen_std": F.sqrt(ratio * (1 - ratio))})


def every_day(runs: DataFrame) -> DataFrame:
    """A row for each day of the panel: ``day`` and its ``age``, the days since the row's sighting,
    negative before the first one of the series.  Needs ``first``."""
    start = F.when(F.col("cumulative_seen") == 1, F.least("first", "date")).otherwise(F.col("date"))
    stop = F.date_add("date", F.col("ahead") - 1)
    stretched = runs.withColumn("day", F.explode(F.sequence(start, stop)))
    return stretched.withColumn("age", F.datediff("day", "date"))


def cumulative_seen(runs: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """(series, date, cumulative_seen) of every day."""
    seen = F.when(F.col("age") >= 0, F.col("cumulative_seen")).otherwise(F.lit(0))
    return every_day(runs).select(*keys, F.col("day").alias("date"), seen.alias("cumulative_seen"))


def days_since_last_seen(runs: DataFrame, strict: bool = False, keys: Sequence[str] = SERIES) -> DataFrame:
    """(series, date, days_since_last_seen) of every day; a sighting counts from the next day on if
    ``strict``, where days before the first are 0 and not null."""
    age = F.col("age")
    if strict:
        since = F.when(age > 0, age).when(age == 0, F.coalesce("gap", F.lit(0))).otherwise(F.lit(0))
    else:
        since = F.when(age >= 0, age)
    return every_day(runs).select(*keys, F.col("day").alias("date"), since.alias("days_since_last_seen"))


def seen_streak(runs: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """(series, date, seen_streak) of every day, 0 on a day without a sighting."""
    streak = F.when(F.col("age") == 0, F.col("streak")).otherwise(F.lit(0))
    return every_day(runs).select(*keys, F.col("day").alias("date"), streak.alias("seen_streak"))


def _recent(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_bits``, the sightings of the last ``LOOK_BACK`` days with the row's own day as bit 0, and
    ``_sums``, whose entry n is the sum of observations of the last n of 14 days."""
    # a series has one row a day at most, so these rows hold the days
    window = W.partitionBy(*keys).orderBy("date").rowsBetween(1 - LOOK_BACK, 0)
    back = lambda x: F.datediff("date", x["date"])
    rows = runs.withColumn("_near", F.collect_list(F.struct("date", "observations")).over(window))
    rows = rows.withColumn("_near", F.filter("_near", lambda x: back(x) < LOOK_BACK))
    bit = lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1), back(x)))
    spent = lambda n: F.aggregate(
        F.filter("_near", lambda x: back(x) < n), F.lit(0).cast("long"), lambda acc, x: acc + x["observations"])
    return rows.withColumns({
        "_bits": F.aggregate("_near", F.lit(0), bit),
        "_sums": F.transform(F.sequence(F.lit(0), F.lit(14)), spent),
    }).drop("_near")


def trend_ratios(runs: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Change of the seen ratio, activity spike, sudden drop and volatility of every day.

    Each sighting's row carries the sightings of the last three weeks as bits and the sums of
    observations of the last 0 to 14 days, which are taken over sighting days only; a later day shifts
    the bits and looks up a shorter sum.
    """
    rows = every_day(_recent(runs, keys))
    after = F.col("age") >= 0
    length = F.datediff("day", "first") + 1  # days of the panel so far
    age = F.when(after, F.col("age")).otherwise(F.lit(0))
    bits = F.when(after & (age < LOOK_BACK), F.call_function("shiftleft", F.col("_bits").cast("long"), age)).otherwise(F.lit(0).cast("long"))

    def seen(n: int, back: int = 0) -> Column:
        return F.bit_count(F.shiftright(bits, back).bitwiseAND(F.lit((1 << n) - 1).cast("long")))

    def spent(n: int) -> Column:
        return F.when(after, F.get("_sums", F.greatest(F.lit(n) - age, F.lit(0)))).otherwise(F.lit(0))

    days = lambda n, back=0: F.least(F.lit(n), length - back)
    k, n = seen(14), days(14)
    ratio = k / n
    before = F.when(length > 7, seen(14, 7) / days(14, 7))
    deviation = F.when(n > 1, F.sqrt((k - k * k / n) / (n - 1)))
    spike = (spent(14) / n) / (spent(7) / days(7) + F.lit(1e-6))
    streak = F.when(F.col("age") == 0, F.col("streak")).otherwise(F.lit(0))
    previous = (
        F.when(F.col("age") == 1, F.col("streak"))
        .when((F.col("age") == 0) & (F.col("gap") == 1), F.col("streak") - 1).otherwise(F.lit(0))
    )
    return rows.select(
        *keys, F.col("day").alias("date"),
        F.coalesce(ratio - before, F.lit(0.0)).alias("seen_ratio_diff"),
        F.coalesce(spike, F.lit(0.0)).alias("obs_ratio_spike"),
        previous.alias("seen_streak_prev"),
        F.coalesce(deviation / (ratio + F.lit(1e-5)), F.lit(0.0)).alias("volatility_ratio"),
        ((previous >= 5) & (streak == 0)).cast("int").alias("recent_drop_flag"),
    )
