"""Aggregations.

Lists gathered per key are distinct values of small domains (partners, owners, tags, days), which
Spark combines before the shuffle, so a hot key never sends all its rows to one task.  Exact
percentiles are taken with the built-in only where the value is a 0–1000 integer score (at most
1,001 distinct values per group); everything else goes through ``exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import columns as fx
from .lists import PART_ITEMS, bounded_lists
from .ordering import add_row_number, exact_quantiles
from .timeseries import first_rows, rank_narrow


def _sorted_set(value: Column) -> Column:
    return F.array_sort(F.collect_set(value))


def sources_per_indicator(records: DataFrame) -> DataFrame:
    """Distinct sorted owner names per indicator."""
    return records.groupBy("indicator").agg(_sorted_set(F.col("ownerName")).alias("sources"))


def condense_tags(
    tags: DataFrame,
    columns: Sequence[str] = ("tag", "threat_category", "nation_state", "cve_nbr"),
    category: str | None = None,
) -> DataFrame:
    """Distinct sorted values of every tag column per indicator, comma-joined, null if none."""
    rows = tags if category is None else tags.where(F.col("threat_category") == category)

    def joined(c: str) -> Column:
        return F.nullif(F.array_join(_sorted_set(fx.blank_to_null(F.col(c))), ", "), F.lit("")).alias(c)

    return rows.groupBy("indicator").agg(*[joined(c) for c in columns])


def tags_to_list(records: DataFrame) -> DataFrame:
    """Tag names of a record as a plain list, without a shuffle."""
    names = F.transform(F.coalesce("tags", F.array()), lambda t: t["name"])
    return records.withColumn("tag_list", F.filter(names, lambda n: n != ""))


def botnet_tags(records: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Those names of ``tag_list`` that are tags of interest, as ``botnet_tags``."""
    wanted = [t.lower() for t in tags]
    return records.withColumn(
        "botnet_tags", F.filter("tag_list", lambda t: F.lower(F.trim(t)).isin(*wanted))
    )


def tag_counts(records: DataFrame, tags: Sequence[str], name: str = "name") -> DataFrame:
    """Uses of each tag of interest, ignoring case, zero included."""
    spark = records.sparkSession
    names = records.select(F.explode("tags").alias("t")).select(F.lower(F.trim(f"t.{name}")).alias("_tag"))
    counts = names.groupBy("_tag").agg(F.count("*").alias("n"))
    wanted = spark.createDataFrame([(t,) for t in tags], "tag string")
    return wanted.join(counts, F.lower("tag") == F.col("_tag"), "left").select(
        "tag", F.coalesce("n", F.lit(0)).alias("n")
    )


def top_groups_by_type(records: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent group names per group type with the type's total."""
    groups = records.select(F.explode("associatedGroups").alias("g")).select(
        F.col("g.type").alias("group_type"), F.col("g.name").alias("group_name")
    )
    names = groups.groupBy("group_type", "group_name").agg(F.count("*").alias("n"))
    totals = names.groupBy("group_type").agg(F.sum("n").alias("type_total"))
    rank = F.row_number().over(W.partitionBy("group_type").orderBy(F.col("n").desc(), "group_name"))
    top = names.withColumn("rank", rank).where(F.col("rank") <= n)
    return top.join(totals, "group_type")


def _window(obs: DataFrame, as_of: str, days: int) -> DataFrame:
    """Sightings on or after ``as_of − days``, up to ``as_of``."""
    day = F.lit(as_of).cast("date")
    return obs.where((F.col("obs_date") >= F.date_sub(day, days)) & (F.col("obs_date") <= day))


def mass_scanner_flags(
    obs: DataFrame, as_of: str, days: int = 7, min_total: int = 1_000_000, min_partners: int = 5
) -> DataFrame:
    recent = _window(obs, as_of, days)
    out = recent.groupBy("indicator").agg(
        F.sum("observations").alias("total_obs"),
        F.size(F.collect_set("OpDiv")).alias("unique_partners"),
        F.size(F.collect_set("obs_date")).alias("unique_days"),
    )
    return out.withColumn(
        "mass_scanner",
        (F.col("total_obs") >= min_total) & (F.col("unique_partners") >= min_partners),
    )


def multi_partner(obs: DataFrame, as_of: str, days: int = 2, k: int = 2) -> DataFrame:
    """Indicators seen by at least ``k`` partners in the last ``days`` days."""
    out = _window(obs, as_of, days).groupBy("indicator").agg(_sorted_set(F.trim("OpDiv")).alias("partners"))
    return out.withColumn("partner_count", F.size("partners")).where(F.col("partner_count") >= k)


def partners_from_tags(records: DataFrame, known: Sequence[str] = fx.KNOWN_PARTNERS) -> DataFrame:
    """Partners named by agency tags or by stand-alone tags with a known partner's name."""
    tags = records.select("indicator", F.explode("tags").alias("t")).select(
        "indicator", fx.agency_tag(F.col("t.name")).alias("tag")
    )
    partner = F.when(
        F.col("tag").endswith(fx.AGENCY_SUFFIX), F.regexp_replace("tag", " Splunk API$", "")
    ).when(F.trim("tag").isin(*known), F.trim("tag"))
    named = tags.select("indicator", partner.alias("partner"))
    return named.groupBy("indicator").agg(_sorted_set(F.nullif("partner", F.lit(""))).alias("partners_from_tags"))


def combine_partners(
    base: DataFrame, tags: DataFrame, obs: DataFrame, known: Sequence[str] = fx.KNOWN_PARTNERS
) -> DataFrame:
    """Union of the partners known from sightings and from tags, with their number."""
    empty = F.array().cast("array<string>")
    seen = obs.groupBy("indicator").agg(_sorted_set(F.trim("OpDiv")).alias("_seen"))
    named = partners_from_tags(tags, known)
    out = base.join(named, "indicator", "left").join(seen, "indicator", "left")
    partners = F.array_union(F.coalesce("_seen", empty), F.coalesce("partners_from_tags", empty))
    return (
        out.withColumn("partners", F.array_sort(partners))
        .withColumn("partner_count", F.size("partners"))
        .drop("_seen", "partners_from_tags")
    )


def first_non_null_record(
    records: DataFrame, key: str, cols: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Per key, the first non-null value of every column in an explicit order."""
    position = F.struct(*order)
    return records.groupBy(key).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in cols]
    )


def flatten_enrichment(
    records: DataFrame, key: str = "indicator", lists: Sequence[str] = ("domains", "tags"),
    texts: Sequence[str] = ("country",), numbers: Sequence[str] = ("vtMaliciousCount",), part_items: int = PART_ITEMS,
) -> DataFrame:
    """Provider results gathered per key: distinct list items and texts, largest number.

    Items are made distinct one by one, so what a task holds does not grow with the combinations in
    which they come, and lists of more than ``part_items`` items go on in the next ``part``.
    """
    rows = records.select(key, F.explode("enrichment").alias("e"))
    none = F.array().cast("array<string>")

    def named(c: str) -> Column:
        return F.transform(F.coalesce(f"e.{c}", none), lambda v: F.struct(F.lit(c).alias("kind"), v.alias("v")))

    kinds = [
        *[named(c) for c in lists],
        *[F.array(F.struct(F.lit(c).alias("kind"), F.col(f"e.{c}").alias("v"))) for c in texts],
    ]
    items = rows.select(key, F.explode(F.concat(*kinds)).alias("x")).select(key, "x.kind", "x.v")
    parts = bounded_lists(items, (key, "kind"), F.col("v"), "_list", part_items)
    wide = parts.groupBy(key, "part").agg(
        *[F.max(F.when(F.col("kind") == c, F.col("_list"))).alias(f"enrich_{c}") for c in (*lists, *texts)])
    totals = rows.groupBy(key).agg(*[F.max(f"e.{c}").alias(f"enrich_{c}") for c in numbers])
    # keys without any item have part 0 of empty lists
    joined = totals.withColumnRenamed(key, "_key").join(wide, F.col("_key").eqNullSafe(F.col(key)), "left")
    return joined.select(
        F.col("_key").alias(key), F.coalesce("part", F.lit(0)).alias("part"),
        *[F.coalesce(f"enrich_{c}", none).alias(f"enrich_{c}") for c in (*lists, *texts)], *[f"enrich_{c}" for c in numbers])


def pivot_enrichment(
    records: DataFrame, spec: Mapping[str, tuple[str, str]], key: str = "indicator"
) -> DataFrame:
    """Fields of named providers as columns: ``{out: (provider, field)}``."""
    rows = records.select(key, F.explode("enrichment").alias("e"))
    return rows.groupBy(key).agg(
        *[
            F.max(F.when(F.col("e.type") == provider, F.col(f"e.{field}"))).alias(out)
            for out, (provider, field) in spec.items()
        ]
    )


def domain_fanout(records: DataFrame, domains: str = "domains") -> DataFrame:
    """Distinct indicators per domain, most first."""
    pairs = records.select("indicator", F.explode(domains).alias("domain")).where(
        F.col("domain").isNotNull()
    )
    # distinct pairs first: a domain shared by very many indicators is then only counted
    return pairs.distinct().groupBy("domain").agg(F.count("*").alias("indicator_count"))


def observed_days(obs: DataFrame, as_of: str, days: int = 365) -> DataFrame:
    return _window(obs, as_of, days).groupBy("indicator").agg(
        F.size(F.collect_set("obs_date")).alias("obs_days")
    )


def duplicate_expansion(df: DataFrame, count: str) -> DataFrame:
    """Repeat each row ``count`` times with a running copy number."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(count).cast("int")))).where(
        F.col(count) > 0
    )


def occurrence_expansion(df: DataFrame, key: str) -> DataFrame:
    """Count the rows per key, then repeat each key that many times."""
    counted = df.groupBy(key).agg(F.count("*").alias("occurrences"))
    return duplicate_expansion(counted, "occurrences")


def daily_counts(df: DataFrame, key: str, date: str, as_of: str) -> DataFrame:
    """Rows per key and day, zero-filled from the key's first day to ``as_of``."""
    counts = df.groupBy(key, F.col(date).alias("date")).agg(F.count("*").alias("n"))
    series = W.partitionBy(key).orderBy("date")
    until = F.coalesce(F.date_sub(F.lead("date").over(series), 1), F.lit(as_of).cast("date"))
    stretched = counts.withColumn("_until", until).withColumn(
        "_day", F.explode(F.sequence("date", "_until"))
    )
    n = F.when(F.col("_day") == F.col("date"), F.col("n")).otherwise(0)
    return stretched.select(key, F.col("_day").alias("date"), n.alias("n"))


def top_k_pivot(df: DataFrame, key: str, date: str, value: str, k: int = 10) -> DataFrame:
    """Long form of the date × top-k-keys matrix; ``slot`` is the key's rank."""
    totals = df.groupBy(key).agg(F.sum(value).alias("total")).orderBy(F.col("total").desc(), key).limit(k)
    # k rows, so numbering them in one task is bounded
    slots = totals.withColumn("slot", F.row_number().over(W.orderBy(F.col("total").desc(), key)))
    days = df.groupBy(key, date).agg(F.sum(value).alias(value))
    matched = days.join(F.broadcast(slots.select(key, "slot")), key)
    wide = matched.groupBy(date).pivot("slot", list(range(1, k + 1))).agg(F.sum(value))
    return wide.na.fill(0).withColumnsRenamed({str(i): f"top_{i}" for i in range(1, k + 1)})


def describe_group(df: DataFrame, by: str, value: str, places: int = 2) -> DataFrame:
    """Count, mean, median, std, min and max of a column per group.

    Medians of all groups come from one range sort over groups and values, so neither a group nor its
    number of distinct values is bound to one task.
    """
    stats = df.groupBy(F.col(by).alias("_by")).agg(
        F.count(value).alias("count"), F.round(F.avg(value), places).alias("mean"),
        F.round(F.stddev_samp(value), places).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
    )
    middle = exact_quantiles(df, value, (0.5,), (by,))
    both = stats.join(middle, F.col("_by").eqNullSafe(F.col(by)), "left")
    return both.select(
        F.col("_by").alias(by), "count", "mean", F.round(F.col("q0").cast("double"), places).alias("median"), "std", "min", "max")


def describe_partners(df: DataFrame, partners: str = "partners", value: str = "score") -> DataFrame:
    exploded = df.select(F.explode(partners).alias("partner"), value)
    return describe_group(exploded, "partner", value)


def multi_stat_features(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Mean, std, max and min of every column per key, gaps as 0.

    Where the temporal features are among the columns, three derived features are added.
    """
    stats = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}
    out = df.groupBy(key).agg(
        *[F.coalesce(fn(c), F.lit(0)).alias(f"{c}_{name}") for c in cols for name, fn in stats.items()]
    )
    derived = {
        "streak_volatility": lambda a, b: a * b,
        "obs_spike_diff": lambda a, b: a - b,
        "rolling_ratio_diff": lambda a, b: a / (b + F.lit(1e-6)),
    }
    parts = (
        ("seen_streak", "volatility_ratio"), ("obs_ratio_spike", "seen_ratio_diff"),
        ("rolling_seen_ratio_7d", "rolling_obs_7d"),
    )
    for (name, combine), (left, right) in zip(derived.items(), parts):
        if left in cols and right in cols:
            out = out.withColumn(name, combine(F.col(f"{left}_mean"), F.col(f"{right}_mean")))
    return out


def sample_skew(value: str) -> Column:
    """Skewness with the sample correction; undefined below three values."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def score_distribution(
    df: DataFrame, col: str = "score", percentiles: Sequence[int] = (10, 25, 50, 75, 90, 95, 99)
) -> DataFrame:
    """One row: moments, percentiles and severity shares of an integer score."""
    level = fx.severity(F.col(col))
    return df.agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        sample_skew(col).alias("skew"),
        *[F.percentile(col, F.lit(p / 100)).alias(f"p{p}") for p in percentiles],
        *[
            (F.count_if(level == name) * 100 / F.count(col)).alias(f"{name}_pct")
            for name in fx.SEVERITY_LABELS
        ],
    )


def ecdf(df: DataFrame, col: str, key: str = "indicator") -> DataFrame:
    """Cumulative share by sorted score; tied scores get distinct ranks, ordered by ``key``."""
    ranked = add_row_number(df.select(key, col), [F.col(col).asc(), F.col(key).asc()], "rank")
    total = df.agg(F.count("*")).scalar()
    return ranked.withColumn("share", F.col("rank") / total)


def partner_severity_crosstab(
    df: DataFrame, row: str, col: str, values: Sequence[str] = fx.SEVERITY_LABELS
) -> DataFrame:
    """Counts of ``col`` values per ``row``, zero-filled, with a total."""
    counts = [F.count_if(F.col(col) == v).alias(v) for v in values]
    out = df.groupBy(row).agg(*counts)
    total = sum((F.col(v) for v in values), F.lit(0))
    return out.withColumn("total", total)


def over_representation(
    df: DataFrame, by: str = "partners", score: str = "score", key: str = "indicator",
    tiers: Sequence[float] = (0.10, 0.05),
) -> DataFrame:
    """Share of each partner in the top tiers minus its share overall."""
    rows = df
    total = df.agg(F.count("*")).scalar()
    order = [(score, True), (key, False)]
    ranked = rank_narrow(df, order)
    for p in tiers:
        inside = first_rows(ranked, order, F.ceil(total * F.lit(p)))
        rows = rows.withColumn(f"_top{int(p * 100)}", inside.cast("int"))
    names = F.when(F.size(by) > 0, F.col(by)).otherwise(F.array(F.lit("No Partner")))
    marks = [f"_top{int(p * 100)}" for p in tiers]
    exploded = rows.select(F.explode(names).alias("partner"), *marks)
    counts = exploded.groupBy("partner").agg(
        F.count("*").alias("overall"), *[F.sum(m).alias(m) for m in marks]
    )
    whole = exploded.agg(F.struct(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in marks])).scalar()
    out = counts.withColumn("overall_pct", F.col("overall") * 100 / whole["n"])
    for m in marks:
        name = m[1:]
        out = out.withColumn(f"{name}_pct", F.col(m) * 100 / whole[m]).withColumn(
            f"{name}_over", F.col(f"{name}_pct") - F.col("overall_pct")
        ).withColumnRenamed(m, name)
    return out


def actor_partner_reach(df: DataFrame, actors: str = "actors", partners: str = "partners") -> DataFrame:
    """Distinct partners per actor."""
    pairs = df.select(F.explode(actors).alias("actor"), partners).select(
        F.trim("actor").alias("actor"), F.explode(partners).alias("partner")
    )
    out = pairs.groupBy("actor").agg(_sorted_set(F.trim("partner")).alias("partners"))
    return out.withColumn("partner_count", F.size("partners"))


def actor_recurrence(
    reports: DataFrame, tags: DataFrame, horizons: Sequence[int] = (7, 14, 30)
) -> DataFrame:
    """Per actor: indicators and mean forecast probability per horizon."""
    chances = reports.groupBy("indicator").agg(
        *[F.avg(fx.percent(F.col(f"`Probability: {h}-Day`"))).alias(f"mean_{h}") for h in horizons]
    )
    joined = tags.select("indicator", "actor").distinct().join(chances, "indicator")
    return joined.groupBy("actor").agg(
        F.count("*").alias("indicators"), *[F.avg(f"mean_{h}").alias(f"mean_{h}") for h in horizons]
    )


def ranked_mode(df: DataFrame, key: str, col: str, ranks: Mapping[str, int]) -> DataFrame:
    """Most common value per key, ties going to the higher rank."""
    rank = F.coalesce(*[F.when(F.col(col) == v, F.lit(n)) for v, n in ranks.items()], F.lit(-1))
    counts = df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count("*").alias("_n"))
    return counts.groupBy(key).agg(F.max_by(col, F.struct("_n", rank, F.col(col))).alias(col))


def daily_report_rollup(
    df: DataFrame, numbers: Sequence[str], percents: Sequence[str], labels: Sequence[str],
    texts: Sequence[str] = (), key: str = "Indicator", order: str = "FileDate",
) -> DataFrame:
    """Per indicator: mean of numbers and percents, most common label, first text.

    Tied labels take the smallest one, like a sorted mode.  Means are rounded by the value of the double and
    not by its shortest decimal text, so a mean of 31.125 prints as 31.12.
    """
    q = lambda c: F.col(f"`{c}`")
    percent_text = lambda c: F.coalesce(
        F.concat(fx.two_places(F.avg(fx.percent(q(c)))), F.lit("%")), F.lit("unknown")
    )
    return df.groupBy(key).agg(
        *[fx.round_scaled(F.avg(q(c))).alias(f"{c} (Average)") for c in numbers],
        *[percent_text(c).alias(f"{c} (Average)") for c in percents],
        *[F.mode(F.coalesce(q(c), F.lit("unknown")), True).alias(f"{c} (Mode)") for c in labels],
        *[F.min_by(q(c), F.struct(order, q(c))).alias(f"{c} (First)") for c in texts],
    )


def median_impute_by_key(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Null → median of its key, else the overall median.

    Each column takes one range sort over keys and values for all keys, and one over its values.
    """
    out = df
    for c in cols:
        own = exact_quantiles(df, c, (0.5,), (key,)).select(F.col(key).alias("_key"), F.col("q0").cast("double").alias("_own"))
        whole = exact_quantiles(df, c, (0.5,)).select("q0").scalar()
        out = out.join(own, F.col(key).eqNullSafe(F.col("_key")), "left")
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col("_own"), whole.cast("double"))).drop("_key", "_own")
    return out


def correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column with the target, strongest first."""
    one = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in cols])
    return one.select(F.inline(entries)).orderBy(F.abs("correlation").desc_nulls_last(), "feature")


def score_shift_summary(df: DataFrame, old: str, new: str, big: int = 100) -> DataFrame:
    """One row describing ``new − old`` for integer scores."""
    rows = df.where(F.col(old).isNotNull() & F.col(new).isNotNull()).select(
        (F.col(new) - F.col(old)).alias("d")
    )
    d, n = F.col("d"), F.count("*")

    def share(condition: Column, name: str) -> list[Column]:
        return [
            F.count_if(condition).alias(f"{name}_count"),
            (F.count_if(condition) * 100 / n).alias(f"{name}_pct"),
        ]

    return rows.agg(
        n.alias("n"),
        F.avg(d).alias("mean"),
        F.percentile(d, F.lit(0.5)).alias("median"),
        F.stddev_samp(d).alias("std"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
        *share(d > 0, "improved"),
        *share(d == 0, "unchanged"),
        *share(d < 0, "degraded"),
        F.coalesce(F.avg(F.when(d > 0, d)), F.lit(0.0)).alias("mean_improvement"),
        F.abs(F.coalesce(F.avg(F.when(d < 0, d)), F.lit(0.0))).alias("mean_degradation"),
        *share(d >= big, "large_up"),
        *share(d <= -big, "large_down"),
    )


def landscape_summary(
    df: DataFrame, score: str = "score", partners: str = "partners", seen: str = "last_observed"
) -> DataFrame:
    """One-row overview: totals, span, quartile counts, partner shares, trend texts, risk level."""
    rows = df.select(F.col(score).alias("s"), F.size(partners).alias("k"), F.col(seen).alias("day"))
    n = F.count("*")
    stats = rows.agg(
        n.alias("total"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.percentile("s", F.lit(0.5)).alias("median"),
        F.avg("s").alias("mean"),
        F.stddev_samp("s").alias("std"),
        F.min("s").alias("min"),
        F.max("s").alias("max"),
        sample_skew("s").alias("skew"),
        F.percentile("s", F.array(*[F.lit(p) for p in (0.25, 0.75, 0.9, 0.95)])).alias("_q"),
        F.avg("k").alias("mean_partners"),
        F.max("k").alias("max_partners"),
        (F.count_if(F.col("k") == 0) * 100 / n).alias("no_partner_pct"),
        (F.count_if(F.col("k") == 1) * 100 / n).alias("one_partner_pct"),
        (F.count_if(F.col("k") > 1) * 100 / n).alias("multi_partner_pct"),
    )
    cuts = stats.select("_q").scalar()
    tiers = rows.agg(
        F.struct(
            F.count_if(F.col("s") <= cuts[0]).alias("low"),
            F.count_if((F.col("s") > cuts[0]) & (F.col("s") <= cuts[1])).alias("medium"),
            F.count_if(F.col("s") > cuts[1]).alias("high"),
        )
    ).scalar()
    median, skew, multi = F.col("median"), F.col("skew"), F.col("multi_partner_pct")
    return stats.withColumns(
        {
            "low_count": tiers["low"],
            "medium_count": tiers["medium"],
            "high_count": tiers["high"],
            "score_trend": F.when(skew > 0.5, "right-skewed").when(skew < -0.5, "left-skewed")
            .otherwise("balanced"),
            "partner_trend": F.when(multi > 40, "high multi-partner involvement")
            .when(F.col("no_partner_pct") > 50, "low partner involvement")
            .otherwise("balanced partner engagement"),
            "tier_trend": F.when(F.col("_q")[3] - F.col("_q")[2] > 20, "clear tier separation")
            .otherwise("compressed high end"),
            "risk_level": F.when(median > 75, "HIGH").when(median > 60, "MODERATE-HIGH")
            .when(median < 40, "LOW-MODERATE").otherwise("MODERATE"),
        }
    ).drop("_q")


def recent_activity(placed: DataFrame, total: Column, score: str = "score") -> DataFrame:
    """Per recency period: count, share of all rows, mean and median of an integer score."""
    return placed.groupBy("period").agg(
        F.count("*").alias("count"),
        (F.count("*") * 100 / F.max(total)).alias("pct"),
        F.avg(score).alias("mean"),
        F.percentile(score, F.lit(0.5)).alias("median"),
    )


def recency_counts(
    df: DataFrame, as_of: str, date_col: str, days: Sequence[int] = (30, 60, 90)
) -> DataFrame:
    age = F.datediff(F.lit(as_of).cast("date"), F.col(date_col))
    return df.agg(
        F.count("*").alias("total"), *[F.count_if(age <= n).alias(f"last_{n}") for n in days]
    )


def component_importance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean over rows of each component's share of the row's absolute total, in percent."""
    size = sum((F.abs(F.coalesce(F.col(c), F.lit(0.0))) for c in cols), F.lit(0.0))
    shares = df.withColumn("_size", size).where(F.col("_size") > 0)
    one = shares.agg(
        *[F.avg(F.abs(F.coalesce(F.col(c), F.lit(0.0))) * 100 / F.col("_size")).alias(c) for c in cols]
    )
    return one.unpivot([], list(cols), "component", "share_pct")


def probability_groups(
    df: DataFrame, col: str, score: str = "score", low: float = 25, high: float = 75
) -> DataFrame:
    """High / medium / low probability groups: score statistics and severity shares.

    Quartiles come from one range sort, since a group may hold most of the rows.
    """
    group = F.when(F.col(col) >= high, "high").when(F.col(col) <= low, "low").otherwise("medium")
    level = fx.severity(F.col(score))
    rows = df.where(F.col(col).isNotNull()).withColumn("probability_group", group)
    stats = rows.groupBy("probability_group").agg(
        F.count("*").alias("count"),
        F.avg(score).alias("mean_score"),
        *[
            (F.count_if(level == name) * 100 / F.count("*")).alias(f"{name}_pct")
            for name in fx.SEVERITY_LABELS
        ],
    )
    quartiles = exact_quantiles(rows, score, (0.25, 0.75), ("probability_group",))
    quartiles = quartiles.select("probability_group", F.col("q0").cast("double").alias("q25"), F.col("q1").cast("double").alias("q75"))
    return stats.join(quartiles, "probability_group", "left")


def partner_tier_stats(
    df: DataFrame, partners: str = "partners", score: str = "score", key: str = "indicator"
) -> DataFrame:
    """No / one / several partners for all rows, the top 10 % and the top 5 %, with lift."""
    total = df.agg(F.count("*")).scalar()
    order = [(score, True), (key, False)]
    ranked = rank_narrow(df, order)
    tiers = [F.lit("all")] + [
        F.when(first_rows(ranked, order, F.ceil(total * F.lit(p))), name)
        for p, name in ((0.10, "top_10"), (0.05, "top_5"))
    ]
    rows = df.select(
        F.size(partners).alias("k"), F.explode(F.array_compact(F.array(*tiers))).alias("tier")
    )
    n, k = F.count("*"), F.col("k")
    cases = {"none": k == 0, "single": k == 1, "multiple": k >= 2}
    overall = df.agg(F.avg(F.size(partners))).scalar()
    out = rows.groupBy("tier").agg(
        n.alias("count"),
        *[F.count_if(c).alias(name) for name, c in cases.items()],
        *[(F.count_if(c) * 100 / n).alias(f"{name}_pct") for name, c in cases.items()],
        F.avg("k").alias("mean_partners"),
    )
    return out.withColumn("lift_pct", (F.col("mean_partners") - overall) / overall * 100)


def partner_drift(
    scores: DataFrame, obs: DataFrame, as_of: str, days: int = 30, partners: str = "partners"
) -> DataFrame:
    """All-time partners beside those of the last days; the recent ones win where known."""
    recent = _window(obs, as_of, days).groupBy("indicator").agg(
        _sorted_set(F.nullif(F.trim("OpDiv"), F.lit(""))).alias("recent_partners")
    )
    out = scores.join(recent, "indicator", "left")
    return out.select(
        "indicator",
        F.col(partners).alias("all_time_partners"),
        "recent_partners",
        F.size(partners).alias("all_time_count"),
        F.coalesce(F.size("recent_partners"), F.lit(0)).alias("recent_count"),
        F.coalesce("recent_partners", F.col(partners)).alias("partners"),
    ).withColumn("recent_count", F.greatest("recent_count", F.lit(0)))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairwise correlations in one pass, long form."""
    pairs = [(a, b) for a in cols for b in cols]
    entries = F.array(
        *[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.corr(a, b).alias("corr")) for a, b in pairs]
    )
    return df.agg(entries.alias("e")).select(F.inline("e"))


def available_tags(df: DataFrame, col: str = "tag") -> DataFrame:
    return (
        df.select(F.trim(col).alias(col)).where(F.length(col) > 0).distinct().orderBy(col)
    )


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Share of each value in percent."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    total = df.agg(F.count(col)).scalar()
    return counts.withColumn("share_pct", F.col("n") * 100 / total)
