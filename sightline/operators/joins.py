"""Joins.  No side is forced to broadcast: Spark compares its measured size with the configured
threshold and falls back to a shuffled join beyond it (adaptive execution splits hot keys)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lists import PART_ITEMS, bounded_lists
from .phrases import SHARE_CHARS, phrase_matches


def attach_context(
    df: DataFrame, dim: DataFrame, key: str = "indicator", fill: Mapping | None = None
) -> DataFrame:
    """Left join of per-key aggregates; ``fill`` gives values for keys without context."""
    out = df.join(dim, key, "left")
    return out.na.fill(dict(fill)) if fill else out


def _lookup(df, dim, keys, value, order, pick) -> DataFrame:
    keys = list(keys)
    ready = dim.dropna(subset=[*keys, value])
    return df.join(ready.groupBy(*keys).agg(pick(F.col(value), F.struct(*order)).alias(value)), keys, "left")


def lookup_first(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]
) -> DataFrame:
    """Attach the first ``value`` per key in the explicit ``order``."""
    return _lookup(df, dim, keys, value, order, F.min_by)


def lookup_last(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]
) -> DataFrame:
    return _lookup(df, dim, keys, value, order, F.max_by)


def tag_observation_join(tags: DataFrame, obs: DataFrame) -> DataFrame:
    """Agency tags with the days their partner saw the indicator; repeats are dropped first."""
    seen = obs.select("indicator", "OpDiv", "obs_date").distinct()
    return tags.join(seen, ["indicator", "OpDiv"])


def keep_listed(df: DataFrame, listed: DataFrame, key: str = "indicator") -> DataFrame:
    return df.join(listed, key, "left_semi")


def drop_reported(df: DataFrame, reported: DataFrame, key: str = "indicator") -> DataFrame:
    return df.join(reported, key, "left_anti")


def joined_links(df: DataFrame, key: str, link: str, out: str) -> DataFrame:
    """Distinct links per key as one sorted text."""
    links = F.array_sort(F.collect_set(link))
    return df.groupBy(key).agg(F.array_join(links, ", ").alias(out))


def full_outer_sources(
    left: DataFrame, right: DataFrame, key: str = "search_term", link: str = "link", part_items: int = PART_ITEMS
) -> DataFrame:
    """Distinct links of two feeds per search term in one list, the left feed's first.

    A term with more than ``part_items`` links goes on in the next ``part``.  Terms without links have
    an empty list.
    """
    both = left.select(key, F.lit(0).alias("_side"), link).unionByName(right.select(key, F.lit(1).alias("_side"), link))
    item = F.when(F.col(link).isNotNull(), F.struct("_side", F.col(link).alias("link")))
    parts = bounded_lists(both, (key,), item, "_links", part_items)
    terms = both.select(F.col(key).alias("_term")).distinct()
    texts = F.filter(F.transform("_links", lambda x: x["link"]), lambda x: x != "")
    return terms.join(parts, F.col("_term").eqNullSafe(F.col(key)), "left").select(
        F.col("_term").alias(key), F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce(F.array_join(texts, ", "), F.lit("")).alias("sources"))


def tags_groups_outer(df: DataFrame, key: str = "indicator") -> DataFrame:
    """Every tag of an indicator beside every group of the same indicator, absent sides null.

    The pairs of one *record* are produced inside its own row, as the two lists of a record are
    short; a join of the two exploded tables would pair all tags and groups of a hot indicator.
    """
    tags = F.coalesce(F.nullif(F.col("tags"), F.array()), F.array(F.lit(None)))
    groups = F.coalesce(F.nullif(F.col("associatedGroups"), F.array()), F.array(F.lit(None)))
    exploded = df.select(key, "id", F.explode(tags).alias("_t"), groups.alias("_gs"))
    exploded = exploded.select(key, "id", "_t", F.explode("_gs").alias("_g"))
    return exploded.select(
        key,
        "id",
        F.col("_t.name").alias("tag_name"),
        F.col("_g.id").alias("group_id"),
        F.col("_g.type").alias("group_type"),
        F.col("_g.name").alias("group_name"),
    )


def partner_buckets(df: DataFrame, partners: str = "partners") -> DataFrame:
    """One copy of a row per partner in its list, keyed by the exact partner name."""
    names = F.array_distinct(F.filter(F.transform(partners, F.trim), lambda p: p != ""))
    return df.withColumn("partner", F.explode(names))


# fixed ranges: (label, from days ago, until days ago, the latter exclusive)
RECENCY_RANGES = (("0-7 Days", 7, -1), ("8-14 Days", 14, 7), ("15-21 Days", 21, 14), ("22-30 Days", 30, 21))


def recency_range_join(
    df: DataFrame, as_of: str, date_col: str, ranges: Sequence[tuple[str, int, int]] = RECENCY_RANGES
) -> DataFrame:
    """Rows placed in half-open date ranges ``[as_of − from, as_of − to)``.

    The ranges are a short parameter list, so they become an array in the row and a row lands in
    every range that covers it, without any join.
    """
    age = F.datediff(F.lit(as_of).cast("date"), F.col(date_col))
    hits = [
        F.when((age <= start) & (age > stop), F.lit(label))
        for label, start, stop in ranges
    ]
    return df.withColumn("period", F.explode(F.array_compact(F.array(*hits))))


def keyphrase_join(
    texts: DataFrame, phrases: DataFrame, text: str = "text", phrase: str = "phrase", key: str = "doc_id",
    share_chars: int = SHARE_CHARS,
) -> DataFrame:
    """(text row, phrase) pairs where the phrase occurs literally, ignoring case.

    An automaton over all phrases reads each text once, where it lies; only matches meet the phrases'
    rows, by the phrase itself.  Phrases of more than ``share_chars`` characters in sum take several
    passes, with the matches of a pass written before the next.  ``key`` names the texts' id for
    readers of the result; it need not be unique.  Empty and null phrases match nothing.
    """
    if key not in texts.columns:
        raise ValueError(f"texts have no column {key}")
    ready = phrases.withColumn("_phrase", F.lower(phrase)).where(F.length("_phrase") > 0)
    found = phrase_matches(texts, ready.select("_phrase").distinct(), F.lower(text), share_chars)
    return found.join(ready, "_phrase").drop("_phrase")


def compare_snapshots(prev: DataFrame, curr: DataFrame, key: str, value: str) -> DataFrame:
    """Previous and current value with the change in percent; nothing to compare with → null."""
    joined = prev.select(key, F.col(value).alias("previous")).join(
        curr.select(key, F.col(value).alias("current")), key
    )
    base = F.nullif(F.col("previous"), F.lit(0))
    return joined.withColumn("percent_change", (F.col("current") - F.col("previous")) / base * 100)


def backfill_zero_scores(
    df: DataFrame, fresh: DataFrame, key: str = "indicator", value: str = "score"
) -> DataFrame:
    """Replace zero or missing scores by a fresh non-zero one."""
    new = fresh.where(F.col(value) != 0).groupBy(key).agg(F.max(value).alias("_fresh"))
    empty = F.coalesce(F.col(value), F.lit(0)) == 0
    filled = F.when(empty & F.col("_fresh").isNotNull(), F.col("_fresh")).otherwise(F.col(value))
    return df.join(new, key, "left").withColumn(value, filled).drop("_fresh")


def exclude_by_attribute_author(
    df: DataFrame, attributes: DataFrame, author: str, key: str = "indicator"
) -> DataFrame:
    """Rows with an attribute by somebody else than ``author``, or with no attributes at all."""
    marks = attributes.groupBy(key).agg(
        F.max(F.coalesce(F.col("author") != author, F.lit(True))).alias("_by_others")
    )
    return df.join(marks, key, "left").where(F.coalesce("_by_others", F.lit(True))).drop("_by_others")


def diff_lists(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``a`` that are not in ``b``, sorted."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti").orderBy(key)
