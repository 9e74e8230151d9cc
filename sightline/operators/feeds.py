"""Selection feeds: warning candidates, partner tips, priority feed, tag search, triage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import columns as fx
from .aggregates import multi_partner, pivot_enrichment
from .clean import first_group_id
from .joins import partner_buckets, tag_observation_join
from .lists import PART_ITEMS, bounded_lists
from .phrases import least_match

# ------------------------------------------------------------------ sort, limit, set operations


def top_n(df: DataFrame, col: str, n: int, key: str = "indicator", absolute: bool = False) -> DataFrame:
    """Top ``n`` rows by value (or by size of the value), ties broken by the key."""
    value = F.abs(F.col(col)) if absolute else F.col(col)
    return df.orderBy(value.desc_nulls_last(), key).limit(n)


def top_n_per_group(df: DataFrame, by: str, col: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of ``col`` per group."""
    counts = df.groupBy(by, col).agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy(by).orderBy(F.col("n").desc(), col))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def ordered_lookup(df: DataFrame, keys: DataFrame, key: str = "indicator", position: str = "position") -> DataFrame:
    """Rows whose key is listed, in the order of the list; unplaced keys last."""
    return df.join(keys.select(key, position), key).orderBy(F.col(position).asc_nulls_last(), key)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Concatenate feeds with differing columns; absent columns are null."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def intersect_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def except_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


# ------------------------------------------------------------------------------ warning feeds


def explode_agency_tags(records: DataFrame) -> DataFrame:
    """One row per agency tag with the record's data, partner, group id and all tag names.

    Records whose associated groups are all adversaries are left out.
    """
    groups = F.coalesce("associatedGroups", F.array())
    only_adversaries = (F.size(groups) > 0) & F.forall(groups, lambda g: g["type"] == "Adversary")
    names = F.transform("tags", lambda t: fx.agency_tag(t["name"]))
    rows = first_group_id(records.where(~only_adversaries)).withColumn("all_tags", names)
    rows = rows.withColumn("name", F.explode(F.filter("all_tags", fx.is_agency_tag)))
    return rows.withColumn("OpDiv", fx.agency_partner(F.col("name"))).drop("tags", "associatedGroups")


def _moment(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def _per_indicator(tags: DataFrame) -> DataFrame:
    """Distinct partners per indicator with their number."""
    out = tags.groupBy("indicator").agg(F.array_sort(F.collect_set("OpDiv")).alias("partners"))
    return out.withColumn("partner_count", F.size("partners"))


def _one_per_indicator(tags: DataFrame) -> DataFrame:
    newest = W.partitionBy("indicator").orderBy(F.col("lastModified").desc_nulls_last(), "id", "name")
    return tags.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def _without_tags(tags: DataFrame, excluded: Sequence[str]) -> DataFrame:
    for name in excluded:
        tags = tags.where(~F.array_contains("all_tags", name))
    return tags


def warning_candidates(
    records: DataFrame, obs: DataFrame, as_of: str, max_obs: int = 15_000, max_age: int = 180,
    hours: int = 24, days: int = 2, k: int = 2, excluded: Sequence[str] = ("I&W", "allow-listed"),
) -> DataFrame:
    """Recently observed indicators of several partners, one row each.

    The indicator must have been observed in the last ``hours``, its partner's latest sighting of
    it must lie in the last ``days``, at least ``k`` partners must remain, and it must be young
    enough, small enough and not tagged as reported or allow-listed.
    """
    now = _moment(as_of)
    tags = explode_agency_tags(records)
    sightings = obs.groupBy("indicator", "OpDiv").agg(F.max("obs_date").alias("observed_date"))
    dated = tags.join(sightings, ["indicator", "OpDiv"])
    recent = dated.where(
        (F.col("lastObserved") >= now - F.make_dt_interval(hours=F.lit(hours)))
        & (F.col("observed_date") >= F.date_sub(now.cast("date"), days))
    )
    wanted = recent.where(
        (F.col("observations") < max_obs)
        & (F.col("dateAdded") >= now - F.make_dt_interval(F.lit(max_age)))
    )
    # one row per indicator first: a busy indicator then joins as a single row
    partners = _per_indicator(recent).where(F.col("partner_count") >= k)
    return _without_tags(_one_per_indicator(wanted).join(partners, "indicator"), excluded)


def warning_candidates_expanded(
    records: DataFrame, obs: DataFrame, as_of: str, days: int = 2, k: int = 2,
    excluded: Sequence[str] = ("allow-listed",), reported_tag: str = "I&W",
) -> DataFrame:
    """Candidates without volume and age limits; partners from sightings and tags together.

    ``reported`` says whether the indicator already carries the reported tag.
    """
    tags = explode_agency_tags(records)
    sightings = obs.groupBy("indicator", "OpDiv").agg(F.max("obs_date").alias("observed_date"))
    first_day = F.date_sub(F.lit(as_of).cast("date"), days)
    dated = tags.join(sightings, ["indicator", "OpDiv"]).where(F.col("observed_date") >= first_day)
    seen_by = multi_partner(obs, as_of, days, k).select("indicator", F.col("partners").alias("_seen_by"))
    chosen = _without_tags(_one_per_indicator(dated).join(seen_by, "indicator"), excluded)
    named = F.transform(
        F.filter("all_tags", lambda t: t.contains("API")), lambda t: F.trim(F.replace(t, F.lit(fx.AGENCY_SUFFIX), F.lit("")))
    )
    partners = F.array_sort(F.array_union("_seen_by", F.filter(named, lambda p: p != "")))
    reported = F.when(F.array_contains("all_tags", reported_tag), "Yes").otherwise("No")
    return (
        chosen.withColumn("partners", partners)
        .withColumn("partner_count", F.size("partners"))
        .withColumn("reported", reported)
        .drop("_seen_by")
    )


def report_groups(df: DataFrame, key: str = "search_term", part_items: int = PART_ITEMS) -> DataFrame:
    """One report per group id, and one per indicator outside any group.

    A group's report is named after its only indicator, else ``Group_<id>``; the indicators of a group
    with more than ``part_items`` go on in the next ``part`` of the report.
    """
    clean = df.withColumn("group_id", fx.blank_to_null(F.col("group_id").cast("string")))
    named = clean.where("group_id IS NOT NULL")
    lists = bounded_lists(named, ("group_id",), F.col(key), "indicators", part_items)
    none = F.array().cast(lists.schema["indicators"].dataType)
    # a group whose indicators are all null has an empty report
    grouped = named.select("group_id").distinct().join(lists, "group_id", "left").select(
        "group_id", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("indicators", none).alias("indicators"),
        F.when(F.col("n") == 1, F.get("indicators", F.lit(0))).otherwise(F.concat(F.lit("Group_"), F.col("group_id"))).alias("report"))
    orphans = clean.where(F.col("group_id").isNull() & F.col(key).isNotNull()).select(
        F.lit(None).cast("string").alias("group_id"), F.lit(0).alias("part"), F.array(key).alias("indicators"), F.col(key).alias("report")
    ).distinct()
    return grouped.unionByName(orphans).withColumn("report", F.regexp_replace("report", "[:/]", "_"))


def append_reported(reported: DataFrame, emitted: DataFrame, key: str = "indicator") -> DataFrame:
    return reported.select(key).unionByName(emitted.select(key)).distinct()


def partner_tips(
    records: DataFrame, obs: DataFrame, as_of: str, min_vt: int = 10, scores: DataFrame | None = None
) -> DataFrame:
    """Tips per partner: sighted in the last day, more than ``min_vt`` VT detections.

    An indicator appears once in the bucket of each of its partners.  ``scores`` adds the score.
    """
    now = _moment(as_of)
    tags = explode_agency_tags(records).select(
        "id", "indicator", "OpDiv", "name", "rating", "confidence", "lastObserved", "lastModified", "all_tags"
    )
    fresh = tags.where(F.col("lastObserved") >= now - F.make_dt_interval(F.lit(1)))
    recent = tag_observation_join(fresh, obs.where(F.col("obs_date") >= F.date_sub(now.cast("date"), 1)))
    spec = {
        "vt_count": ("VirusTotal", "vtMaliciousCount"),
        "country": ("Shodan", "country"),
    }
    enriched = pivot_enrichment(records, spec).where(F.col("vt_count") > min_vt)
    one = _one_per_indicator(recent).select("indicator", "rating", "confidence", "obs_date")
    tips = one.join(_per_indicator(recent), "indicator").join(enriched, "indicator")
    if scores is not None:
        tips = tips.join(scores.select("indicator", "score"), "indicator", "left")
    return partner_buckets(tips)


def priority_feed(
    records: DataFrame, scores: DataFrame, obs: DataFrame, as_of: str, hours: int = 48,
    min_rating: float = 3, min_confidence: float = 50, min_vt: int = 14, k: int = 2,
    reported_names: Sequence[str] = ("i&w", "i & w", "iw"),
) -> DataFrame:
    """High and critical indicators seen lately by several partners, with a reported flag.

    Separate assessed columns, where the records have them, count beside the rating and instead
    of the confidence.
    """
    now = _moment(as_of)
    latest = W.partitionBy("indicator").orderBy(F.col("lastObserved").desc_nulls_last(), "id")
    assessed = "threatAssessRating" in records.columns
    rated = F.coalesce(F.col("rating") >= min_rating, F.lit(False))
    if assessed:
        rated = rated | F.coalesce(F.col("threatAssessRating") >= min_rating, F.lit(False))
    sure = F.col("threatAssessConfidence" if assessed else "confidence") >= min_confidence
    trusted = records.where(rated & sure)
    newest = trusted.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1")
    newest = newest.where(F.col("lastObserved") >= now - F.make_dt_interval(hours=F.lit(hours)))
    groups = F.array_join(
        F.transform(F.coalesce("associatedGroups", F.array()), lambda g: F.concat(F.lit("Group Id: "), g["id"])), ", "
    )
    newest = newest.select("indicator", "lastObserved", F.nullif(groups, F.lit("")).alias("associated_groups"))
    marks = trusted.groupBy("indicator").agg(
        F.max(
            F.exists(F.coalesce("tags", F.array()), lambda t: F.lower(F.trim(t["name"])).isin(*reported_names))
        ).alias("_reported")
    )
    vt = fx.vt_score(F.col("explanation"))
    chosen = scores.where((vt >= min_vt) & F.col("severity").isin("high", "critical")).select(
        "indicator", "score", "severity", "explanation"
    )
    return (
        chosen.join(newest, "indicator")
        .join(multi_partner(obs, as_of, 1, k), "indicator")
        .join(marks, "indicator", "left")
        .withColumn("reported", F.when(F.col("_reported"), "Yes").otherwise("No"))
        .drop("_reported")
    )


# ---------------------------------------------------------------------------------- tag search


def tag_search(
    tags: DataFrame, terms: Sequence[str], col: str = "tag", match: str = "contains",
    mode: str = "any", case: bool = False,
) -> DataFrame:
    """Rows whose tag contains or equals any (or all) of the terms, sorted by tag and indicator.

    ``mode='all'`` asks for one tag value that matches every term.
    """
    if not terms:
        raise ValueError("no search terms")
    value = F.trim(F.col(col)) if case else F.lower(F.trim(F.col(col)))
    tests = []
    for term in terms:
        wanted = F.lit(term if case else term.lower())
        tests.append(value == wanted if match == "exact" else value.contains(wanted))
    hit = tests[0]
    for test in tests[1:]:
        hit = hit & test if mode == "all" else hit | test
    return tags.where(F.coalesce(hit, F.lit(False))).orderBy(F.trim(F.col(col)).asc_nulls_last(), "indicator")


def search_scores(tags: DataFrame, scores: DataFrame, terms: Sequence[str], **options) -> DataFrame:
    """Scores of the indicators found by a tag search, best first, unscored last."""
    found = tag_search(tags, terms, **options).select("indicator").distinct()
    return scores.join(found, "indicator", "left_semi").orderBy(F.col("score").desc_nulls_last(), "indicator")


# -------------------------------------------------------------------------------------- triage

# fixed values ---------------------------------------------------------------------------------
BULLETPROOF = (
    "unmanaged", "flokinet", "frantech", "buyvm", "combahton", "serverius", "quasi", "lir.net",
    "leaseweb", "serverstack", "m247", "choopa", "vultr", "pptechnology", "dmzhost", "offshore",
    "sharktech", "psychz",
)
BENIGN_HOSTING = (
    "amazon", "google", "microsoft", "cloudflare", "akamai", "fastly", "digitalocean", "linode",
    "hetzner", "ovh", "level3", "comcast", "att ", "verizon", "spectrum",
)
HIGH_RISK_COUNTRIES = ("China", "Russia", "North Korea", "Iran", "Belarus")
# ----------------------------------------------------------------------------------------------


def _triage_notes(columns: Sequence[str]) -> Column:
    """What the decision on an address rests on, in one line."""
    seen = lambda c, gap: F.coalesce(F.col(c).cast("string"), F.lit(gap)) if c in columns else F.lit(gap)
    flag = lambda c: F.when(F.coalesce(F.col(c), F.lit(False)), "True").otherwise("False")
    parts = {
        "ISP": seen("isp", "unknown"), "Org": seen("org", "unknown"), "Country": seen("country", "unknown"),
        "ASN": seen("asn", ""), "Proxy": flag("proxy"), "Hosting": flag("hosting"),
        "Behavior": F.col("behavior"), "Recommendation": F.col("recommendation"),
    }
    return F.concat_ws(" ", *[F.concat(F.lit(f"{name}: "), value, F.lit(".")) for name, value in parts.items()])


def triage_infrastructure(df: DataFrame) -> DataFrame:
    """Behaviour, flags, recommendation and notes from provider, hosting, proxy and country columns."""
    blank = F.lit("")
    provider = F.lower(
        F.concat_ws(" ", *[F.coalesce(F.col(c), blank) for c in ("isp", "org", "asn_name")])
    )

    def named(words: Sequence[str]) -> Column:
        return provider.rlike("|".join(w.replace(".", r"\.") for w in words))

    shady, cloud = named(BULLETPROOF), named(BENIGN_HOSTING)
    proxy, hosting = (F.coalesce(F.col(c), F.lit(False)) for c in ("proxy", "hosting"))
    is_address = F.coalesce(F.col("indicator_type") == "Address", F.lit(False))
    risky = F.coalesce(F.col("country").isin(*HIGH_RISK_COUNTRIES), F.lit(False))
    rows = df.withColumns(
        {
            "_bulletproof": shady & ~cloud,
            "_cloud": hosting & ~shady & cloud,
            "_generic": hosting & ~shady & ~cloud,
            "_proxy": proxy,
            "_risky": risky,
        }
    )
    b, c, g, p, k = (F.col(x) for x in ("_bulletproof", "_cloud", "_generic", "_proxy", "_risky"))
    flags = F.array_compact(
        F.array(
            F.when(b, F.lit("bulletproof_hosting")),
            F.when(p, F.lit("proxy_anonymizer")),
            F.when(c, F.lit("legitimate_cloud_hosting")),
            F.when(g, F.lit("generic_hosting")),
            F.when(k, F.concat(F.lit("high_risk_country_"), F.replace("country", F.lit(" "), F.lit("_")))),
        )
    )
    behavior = (
        F.when(~is_address, "non_ip")
        .when(c, "cloud_hosted")
        .when(b, "malicious_infrastructure")
        .when(p, "anonymized_traffic")
        .when(g, "hosted_infrastructure")
        .when(k, "unknown")
        .otherwise("insufficient_data")
    )
    advice = (
        F.when(~is_address, "manual_review")
        .when(c, "reduce_score")
        .when(b | p, "elevate_score")
        .when(k, "analyst_review")
        .otherwise("no_change")
    )
    return rows.withColumns(
        {
            "behavior": behavior,
            "flags": F.when(is_address, F.array_join(flags, "; ")).otherwise(""),
            "recommendation": advice,
        }
    ).withColumn("notes", F.when(is_address, _triage_notes(df.columns)).otherwise(F.concat(
        F.lit("Non-IP type ("), F.coalesce("indicator_type", F.lit("unknown")), F.lit("). No automated triage available.")
    ))).drop("_bulletproof", "_cloud", "_generic", "_proxy", "_risky")


def triage_summary(triaged: DataFrame) -> DataFrame:
    return triaged.groupBy("behavior", "recommendation").agg(F.count("*").alias("n"))


def tag_by_asn(
    df: DataFrame, asns: Sequence[int], tag: str = "Known Scanner PB", tags: str = "tag_names"
) -> DataFrame:
    """Address indicators in the networks that do not carry the tag yet, with the tag added."""
    present = F.coalesce(F.col(tags), F.array().cast("array<string>"))
    chosen = df.where(
        (F.col("indicator_type") == "Address")
        & F.col("asn").isin(*asns)
        & ~F.array_contains(present, tag)
    )
    return chosen.withColumn(tags, F.array_append(present, tag))


def categorize_tags(
    tags: DataFrame, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]], col: str = "tag",
    members: Sequence[tuple[str, Sequence[str]]] = (),
) -> DataFrame:
    """Category of each distinct tag.

    A tag that ``members`` (category, tags) lists as written belongs there, whatever the rules say;
    others take the first rule (category, exact, contained) that matches.
    """
    names = tags.select(F.trim(col).alias(col)).where(F.length(col) > 0).distinct()
    # rule numbers: the least one that is met decides, whether by the whole tag or by a part of it
    whole: dict[str, int] = {}
    parts: dict[str, int] = {}
    for number, (_, exact, contained) in enumerate(rules):
        for value in exact:
            whole.setdefault(value.strip().lower(), number)
        for value in contained:
            parts.setdefault(value.lower(), number)
    everywhere = parts.pop("", None)  # an empty part stands in every tag
    rows = least_match(names, parts, F.lower(col), "_part")
    exact_rule = F.element_at(F.create_map(*[F.lit(x) for pair in whole.items() for x in pair]), F.lower(col)) if whole else F.lit(None)
    rule = F.least(F.col("_part"), exact_rule.cast("int"), F.lit(everywhere).cast("int"))
    titles = F.array(*[F.lit(name) for name, _, _ in rules]) if rules else F.array(F.lit("other"))
    listed = F.lit(None).cast("string")
    for name, members_of in reversed(members):
        if members_of:
            listed = F.when(F.col(col).isin(*[t.strip() for t in members_of]), name).otherwise(listed)
    return rows.select(col, F.coalesce(listed, F.get(titles, rule), F.lit("other")).alias("category"))


def tags_per_category(categorized: DataFrame) -> DataFrame:
    return categorized.groupBy("category").agg(F.count("*").alias("n"))


def stable_bucket(df: DataFrame, col: str, n: int) -> DataFrame:
    """SHA-256 of the trimmed text modulo ``n``; blank text → null."""
    return df.withColumn("bucket", F.when(F.length(F.trim(col)) > 0, fx.stable_bucket(F.col(col), n)))


# ---------------------------------------------------------------------------------- attributes


def attribute_flatten(df: DataFrame, order: str, attributes: str = "attributes") -> DataFrame:
    """First attribute of an indicator as ``attr_…`` columns, one row per indicator."""
    first = W.partitionBy("indicator").orderBy(order)
    one = df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    entry = F.get(F.col(attributes), 0)
    fields = df.schema[attributes].dataType.elementType.names
    return one.withColumns({f"attr_{f}": entry[f] for f in fields}).drop(attributes)


def author_filter(
    df: DataFrame, first: str, last: str, order: str, groups: str = "associatedGroups"
) -> DataFrame:
    """One row per indicator written by the named user, with its distinct group names joined."""
    mine = df.where((F.col("author_first") == first) & (F.col("author_last") == last))
    newest = W.partitionBy("indicator").orderBy(order)
    one = mine.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")
    names = F.array_sort(F.array_distinct(F.transform(groups, lambda g: g["name"])))
    return one.withColumn("group_names", F.array_join(names, ", ")).drop(groups)


def master_listing_upsert(
    master: DataFrame, rows: DataFrame, codes: Sequence[str],
    keys: Sequence[str] = ("partner", "report", "indicator"),
) -> DataFrame:
    """Add extracted report rows with the first filled disposition column, one row per key.

    Rows already listed stay as they are.
    """
    keys = list(keys)
    filled = [F.when(F.length(F.trim(c)) > 0, F.lit(n)) for n, c in enumerate(codes, 1)]
    named = [F.when(F.length(F.trim(c)) > 0, F.lit(c)) for c in codes]
    new = rows.withColumn("disposition_code", F.coalesce(*filled)).withColumn("disposition", F.coalesce(*named))
    first = W.partitionBy(*keys).orderBy(F.col("disposition_code").asc_nulls_last(), *codes)
    new = new.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select(
        *keys, "disposition_code", "disposition"
    )
    return master.unionByName(new.join(master.select(*keys), keys, "left_anti"), allowMissingColumns=True)

