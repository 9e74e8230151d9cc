"""The scoring job: from records, sightings and tags to explained scores, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KNOWN_PARTNERS
from ..operators import aggregates as ag
from ..operators.clean import extract_incident_ids
from ..operators.scoring import VERSIONS, Weights, score_components, score_explanation, score_rule

# fixed values: tags that mark botnet activity
BOTNET_TAGS = (
    "Scanning", "DDoS", "Spam", "Phishing", "Cryptojacking", "Credential Stuffing", "Ransomware", "Data Theft",
    "Cross Site Scripting Attacks", "SQL Injections",
)


def _set_of(value: Column) -> Column:
    return F.array_sort(F.collect_set(value))


def score_inputs(
    records: DataFrame, obs: DataFrame, tags: DataFrame, as_of: str, botnet: Sequence[str] = BOTNET_TAGS,
    actor_column: str = "nation_state", known: Sequence[str] = KNOWN_PARTNERS, **mass_scanner: int,
) -> DataFrame:
    """One row per indicator with everything the score needs.

    Every context table is aggregated to one row per indicator before it is joined, so all joins
    run on the partitioning that the aggregations already have, and no key is joined twice.
    """
    newest = (-F.unix_timestamp("lastModified")).alias("t")
    fields = ("type", "rating", "confidence", "calScore", "threatAssessScore", "falsePositives")
    base = ag.first_non_null_record(records, "indicator", fields, (newest, "id"))
    dates = records.groupBy("indicator").agg(
        F.max("lastObserved").alias("last_observed"), F.to_date(F.min("dateAdded")).alias("firstseen_date")
    )
    named = ag.botnet_tags(ag.tags_to_list(records), botnet)
    # tags are made distinct one by one, not in the combinations in which records have them
    tag = named.select("indicator", F.explode_outer("tag_list").alias("tag"), F.lit(None).cast("string").alias("botnet")).unionByName(
        named.select("indicator", F.lit(None).cast("string").alias("tag"), F.explode_outer("botnet_tags").alias("botnet")))
    tag_lists = tag.groupBy("indicator").agg(_set_of(F.col("tag")).alias("tag_names"), _set_of(F.col("botnet")).alias("botnet_tags"))
    labels = extract_incident_ids(records).where("incident_label IS NOT NULL").select(
        "indicator", F.explode(F.split("incident_label", ";")).alias("label")
    )
    incidents = labels.groupBy("indicator").agg(F.array_join(_set_of(F.col("label")), ";").alias("incident"))
    actors = ag.condense_tags(tags, (actor_column,)).withColumnRenamed(actor_column, "threat_actor")
    mass = ag.mass_scanner_flags(obs, as_of, **mass_scanner).select("indicator", "mass_scanner")
    # the score reads the tags of an indicator in one row, so lists in parts, which take a pass over the records first, are of no use here
    found = records.select("indicator", F.explode("enrichment").alias("e")).select(
        "indicator", F.explode_outer("e.tags").alias("tag"), F.col("e.vtMaliciousCount").alias("vt"))
    enriched = found.groupBy("indicator").agg(_set_of(F.col("tag")).alias("enrich_tags"), F.max("vt").alias("enrich_vtMaliciousCount"))
    rows = ag.combine_partners(base, records, obs, known)
    for context in (
        dates, ag.sources_per_indicator(records), tag_lists, incidents, actors, mass, enriched,
        ag.observed_days(obs, as_of),
    ):
        rows = rows.join(context, "indicator", "left")
    return rows.withColumnsRenamed(
        {
            "type": "indicator_type", "calScore": "cal_score", "threatAssessScore": "external_score",
            "falsePositives": "false_positives", "enrich_vtMaliciousCount": "vt_count",
        }
    )


def score_job(
    records: DataFrame, obs: DataFrame, tags: DataFrame, as_of: str, weights: Weights = VERSIONS[4], **options,
) -> DataFrame:
    """Scores, severities and explanations of all indicators in the records."""
    inputs = score_inputs(records, obs, tags, as_of, **options)
    return score_explanation(score_rule(score_components(inputs, as_of, weights), weights), as_of)
