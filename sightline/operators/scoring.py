"""Severity scoring from 0 to 1000: components, rule score, explanation, history, recurrence risk.

All of it is column expressions over one row per indicator, so scoring is a single map stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import blank_to_null, severity


@dataclass(frozen=True)
class Weights:
    """Fixed weights and limits of one score version."""

    malicious: float = 7.50
    continuity: float = 0.90
    rating: float = 0.01
    confidence: float = 0.025
    tor: float = 9.00
    cal: float = 2.75
    external: float = 0.75
    incident: float = 8.00
    partners: float = 2.10
    sources: float = 2.80
    actor: float = 10.00
    first_seen: float = 2.00
    observation_penalty: float = 0.02
    vt_max: float = 40.0
    vt_exponent: float = 0.75
    confidence_exponent: float = 0.5
    rating_without_vt: float | None = None  # weight of the rating when VT is missing
    rating_cap: float | None = None  # weight of the rating inside the cap, where it differs
    tor_cap_factor: float = 2.0
    first_seen_in_cap: bool = True
    context_stack: bool = True
    file_rules: bool = True
    mass_scanner_rules: bool = True
    missing_vt_is_zero: bool = False
    scanner_penalty: float = 0.95
    calibration: float = 1.40

    def cap(self) -> float:
        """Largest possible sum of the additive parts."""
        return (
            self.vt_max**self.vt_exponent * self.malicious
            + 3 * self.continuity
            + 5 * (self.rating if self.rating_cap is None else self.rating_cap)
            + 100**self.confidence_exponent * self.confidence
            + self.tor * self.tor_cap_factor
            + self.incident
            + log1p(8 - 1) * self.sources
            + log1p(10 - 1) * self.partners
            + self.actor
            + self.cal
            + self.external
            + (self.first_seen if self.first_seen_in_cap else 0.0)
            + (25.0 if self.context_stack else 0.0)
        )


_EARLY = dict(
    malicious=1.0, continuity=0.10, rating=0.05, confidence=0.02, tor=3.0, cal=1.0, external=0.0,
    incident=0.0, partners=0.0, sources=0.0, actor=0.0, first_seen=0.0, vt_max=94.0,
    vt_exponent=0.4, confidence_exponent=1.0, context_stack=False, file_rules=False,
    mass_scanner_rules=False, scanner_penalty=0.9, calibration=1.0,
)
VERSIONS = {
    1: Weights(**_EARLY | dict(tor_cap_factor=1.0, missing_vt_is_zero=True)),
    2: Weights(**_EARLY | dict(rating=0.75, rating_without_vt=1.5, rating_cap=0.1, external=0.75, incident=1.5)),
    3: Weights(
        **_EARLY | dict(
            malicious=3.0, confidence=0.5, cal=1.5, external=0.75, incident=4.0, partners=0.85,
            sources=1.0, actor=3.0, first_seen=5.0, first_seen_in_cap=False, file_rules=True,
            scanner_penalty=0.95,
        )
    ),
    4: Weights(),
}

# fixed values ---------------------------------------------------------------------------------
FILE_TYPES = ("SHA1", "SHA256", "MD5", "file", "File")
CONTINUITY = {
    1: ("Address", "IPv4", "IPv6"),
    2: ("Domain", "Host", "URL", "Stripped URL", "EmailAddress", "EmailSubject"),
    3: FILE_TYPES,
}
BOTNET_ACTIONS = (
    "scanning", "ddos", "spam", "phishing", "cryptojacking", "credential stuffing", "ransomware",
)
SCANNERS = (
    "scanner", "masscan", "zmap", "shodan", "censys", "active scanning: scanning ip blocks",
    "web scanner", "active scanning",
)
COMPONENTS = {
    "malicious": "VT malicious (log-scaled)",
    "continuity": "Continuity (indicator type)",
    "rating_part": "TC rating",
    "confidence_part": "TC confidence",
    "tor": "TOR activity",
    "incident_part": "Incident/Event association",
    "sources_part": "Multi-source validation",
    "partners_part": "Partner coverage bonus",
    "actor_part": "Threat actor association",
    "cal_part": "CAL score",
    "external_part": "TC threat assessment",
    "first_seen_part": "Recent first-seen activity",
    "context_bonus": "Reinforcing context bonus",
}
FILE_BASELINE = 900.0
FIRST_SEEN_DAYS = 14
# ----------------------------------------------------------------------------------------------


def score_versions(version: int) -> Weights:
    """Weights of the earlier and the current score."""
    return VERSIONS[version]


def _clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(low)), F.lit(high))


def _distinct_items(values: Column) -> Column:
    clean = F.filter(F.transform(values, F.trim), lambda v: v != "")
    return F.greatest(F.coalesce(F.size(F.array_distinct(clean)), F.lit(0)), F.lit(0))


def _text(*lists: str) -> Column:
    return F.lower(F.concat_ws(" ", *[F.array_join(c, " ") for c in lists]))


def _mentions(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | text.contains(word)
    return out


def score_components(
    df: DataFrame, as_of: str, weights: Weights = VERSIONS[4], tor_match: str = "word"
) -> DataFrame:
    """Add the additive score components and the flags the rule score needs.

    ``tor_match='substring'`` also takes words that merely contain the letters.
    """
    w = weights
    vt = _clip(F.col("vt_count"), 0, w.vt_max)
    vt_present = F.col("vt_count").isNotNull()
    is_file = F.coalesce(F.col("indicator_type").isin(*FILE_TYPES), F.lit(False))
    continuity = F.coalesce(
        *[F.when(F.col("indicator_type").isin(*names), F.lit(float(v))) for v, names in CONTINUITY.items()],
        F.lit(0.0),
    ) * w.continuity
    rating_weight = F.lit(w.rating)
    if w.rating_without_vt is not None:
        rating_weight = F.when(vt_present, F.lit(w.rating)).otherwise(F.lit(w.rating_without_vt))
    tags = _text("tag_names", "enrich_tags")
    tor = tags.rlike(r"\btor\b") if tor_match == "word" else tags.contains("tor")
    tor_boost = vt_present & (vt >= 10) & tor
    age = F.datediff(F.lit(as_of).cast("date"), F.col("firstseen_date"))
    # an unknown date stays null here and counts 0; a date ahead of as_of is fully fresh
    fresh = _clip((FIRST_SEEN_DAYS - age) / FIRST_SEEN_DAYS, 0, 1)
    bonus = (
        F.when(F.col("context_count") >= 4, 25.0).when(F.col("context_count") == 3, 15.0)
        .when(F.col("context_count") == 2, 7.0).otherwise(0.0)
    )
    flags = df.withColumns(
        {
            "vt_value": vt,
            "vt_present": vt_present,
            "is_file": is_file,
            "has_tor": F.coalesce(tor, F.lit(False)),
            "tor_boost": F.coalesce(tor_boost, F.lit(False)),
            "sources_count": _distinct_items(F.col("sources")),
            "partners_count": _distinct_items(F.col("partners")),
            "incident_label": blank_to_null(F.col("incident")),
            "actor_label": blank_to_null(F.col("threat_actor")),
            "has_scanner": F.coalesce(_mentions(tags, SCANNERS), F.lit(False)) & ~is_file,
            "has_botnet": F.coalesce(_mentions(_text("botnet_tags"), BOTNET_ACTIONS), F.lit(False)),
        }
    )
    has_incident, has_actor = F.col("incident_label").isNotNull(), F.col("actor_label").isNotNull()
    tor_points = F.when(F.col("tor_boost"), w.tor * 2).when(F.col("has_tor"), w.tor).otherwise(0.0)

    def grown(count: str, weight: float) -> Column:
        return F.log1p(F.greatest(F.col(count), F.lit(1)) - 1) * weight

    parts = flags.withColumns(
        {
            "malicious": F.pow("vt_value", F.lit(w.vt_exponent)) * w.malicious,
            "continuity": F.when(F.col("is_file"), F.lit(FILE_BASELINE)).otherwise(continuity)
            if w.file_rules else continuity,
            "rating_part": _clip(F.col("rating"), 0, 5) * rating_weight,
            "confidence_part": F.pow(_clip(F.col("confidence"), 0, 100), F.lit(w.confidence_exponent))
            * w.confidence,
            "tor": tor_points,
            "incident_part": F.when(has_incident, w.incident).otherwise(0.0),
            "sources_part": grown("sources_count", w.sources),
            "partners_part": grown("partners_count", w.partners),
            "actor_part": F.when(has_actor, w.actor).otherwise(0.0),
            "cal_part": _clip(F.col("cal_score"), 0, 1000) / 1000 * w.cal,
            "external_part": _clip(F.col("external_score"), 0, 1000) / 1000 * w.external,
            "first_seen_part": fresh * w.first_seen,
        }
    )
    signals = [
        has_actor, F.col("tor") > 0, has_incident, F.col("sources_count") >= 2, F.col("partners_count") >= 2,
    ]
    stacked = parts.withColumn("context_count", sum((s.cast("int") for s in signals), F.lit(0)))
    return stacked.withColumn("context_bonus", bonus if w.context_stack else F.lit(0.0))


def score_rule(components: DataFrame, weights: Weights = VERSIONS[4], parity: bool = False) -> DataFrame:
    """Rule score and severity from the components.

    With ``parity`` the data-quality factor is always 1, as when gaps are filled before counting.
    """
    w = weights
    raw = sum((F.col(c) for c in COMPONENTS), F.lit(0.0))
    observed = F.least(F.greatest(F.coalesce("obs_days", F.lit(0)), F.lit(0)), F.lit(365)) / 365
    quality = sum(
        (F.col(c).isNotNull().cast("int") for c in ("indicator_type", "rating", "confidence")), F.lit(0)
    ) / 3
    not_file = ~F.col("is_file") if w.file_rules else F.lit(True)
    botnet = F.col("has_botnet") & not_file
    mass = F.coalesce(F.col("mass_scanner"), F.lit(False)) & not_file & F.lit(w.mass_scanner_rules)
    scored = components.withColumns(
        {
            "observation_factor": _clip(1 - w.observation_penalty * observed, 0.5, 1),
            "quality_factor": F.lit(1.0) if parity else _clip(quality, 0.85, 1),
            "false_positive_factor": F.when(F.col("false_positives") > 0, 0.9).otherwise(1.0),
            "scanner_factor": F.when(F.col("has_scanner"), w.scanner_penalty).otherwise(1.0),
            "botnet_factor": F.when(botnet, 0.4).otherwise(1.0),
            "mass_scanner_factor": F.when(mass, 0.05).otherwise(1.0),
            "raw_score": raw,
        }
    )
    for factor in ("observation", "quality", "false_positive", "scanner", "botnet", "mass_scanner"):
        scored = scored.withColumn("raw_score", F.col("raw_score") * F.col(f"{factor}_factor"))
    cap = F.lit(w.cap()) + (
        F.when(F.col("is_file"), FILE_BASELINE).otherwise(0.0) if w.file_rules else F.lit(0.0)
    )
    share = _clip(F.col("raw_score") / cap, 0, 1)
    base = F.rint(F.least(1000 * share * w.calibration, F.lit(1000.0))).cast("int")
    vt_known = F.lit(True) if w.missing_vt_is_zero else F.col("vt_present")
    limits = [
        (vt_known & (F.col("vt_value") <= 3) & ~F.col("tor_boost"), F.least, 199),
        (vt_known & (F.col("vt_value") >= 13), F.greatest, 499),
        (botnet & ~F.col("tor_boost"), F.least, 199),
        (mass, F.least, 199),
    ]
    scored = scored.withColumn("score", base)
    for condition, bound, value in limits:
        scored = scored.withColumn(
            "score", F.when(condition, bound("score", F.lit(value))).otherwise(F.col("score"))
        )
    if not w.file_rules:
        return scored.withColumn("severity", severity(F.col("score")))
    return scored.withColumn(
        "severity", F.when(F.col("is_file"), "critical").otherwise(severity(F.col("score")))
    ).withColumn(
        "score", F.when(F.col("is_file"), F.greatest("score", F.lit(800))).otherwise(F.col("score"))
    )


def score_explanation(scored: DataFrame, as_of: str) -> DataFrame:
    """The three largest drivers and the notes as one text."""

    def lit(text: str) -> Column:
        return F.lit(text)

    def either(condition: Column, yes, no) -> Column:
        return F.when(condition, yes).otherwise(no)

    def number(c: str) -> Column:
        return F.col(c).cast("int").cast("string")

    entries = F.array_sort(
        F.array(
            *[
                F.struct((-F.abs(F.col(c))).alias("size"), F.lit(i).alias("pos"), F.lit(label).alias("label"))
                for i, (c, label) in enumerate(COMPONENTS.items())
            ]
        )
    )
    top = F.filter(F.slice(entries, 1, 3), lambda e: e["size"] != 0)
    names = F.transform(
        top,
        lambda e: either(
            (e["label"] == COMPONENTS["actor_part"]) & F.col("actor_label").isNotNull(),
            F.concat(lit("Associated with "), F.col("actor_label")),
            e["label"],
        ),
    )
    drivers = either(F.size(names) > 0, F.array_join(names, "; "), lit("No significant drivers"))
    sources = F.array_join(F.array_distinct(F.filter(F.transform("sources", F.trim), lambda v: v != "")), ", ")
    fresh = (F.col("first_seen_part") > 0) & F.col("firstseen_date").isNotNull()
    notes = [
        F.concat(lit(f"[{as_of}] Severity: "), F.coalesce("severity", lit("nan")), lit(".")),
        either(
            F.col("vt_present"), F.concat(lit("VT score: "), number("vt_value"), lit(".")),
            lit("VT score not available (neutral)."),
        ),
        F.concat(lit("Contextual Drivers: "), drivers, lit(".")),
        either(
            F.col("partners_count") > 0,
            F.concat(lit("Observed across "), number("partners_count"), lit(" partner(s).")),
            lit("No partner attribution."),
        ),
        either(
            F.col("sources_count") > 1,
            F.concat(lit("Observed by "), number("sources_count"), lit(" sources: "), sources, lit(".")),
            lit("Single source observation."),
        ),
        either(
            F.col("context_count") > 0,
            F.concat(number("context_count"), lit(" reinforcing context signal(s).")),
            lit("No reinforcing context stack."),
        ),
        either(F.col("botnet_factor") < 1, lit("Botnet penalty applied."), lit("No botnet penalty.")),
        either(
            F.col("false_positives") > 0,
            F.concat(number("false_positives"), lit(" false positive tag(s).")),
            lit("No false positive tags."),
        ),
        either(F.col("scanner_factor") < 1, lit("Scanner penalty applied."), lit("No scanner penalty.")),
        either(F.col("tor") > 0, lit("TOR activity detected."), lit("No TOR activity.")),
        either(
            F.col("incident_label").isNotNull(),
            F.concat(lit("Linked to incident/event: "), F.col("incident_label"), lit(".")),
            lit("No incident/event link."),
        ),
        F.when(
            F.col("actor_label").isNotNull(),
            F.concat(lit("Associated threat actor(s): "), F.col("actor_label"), lit(".")),
        ),
        F.when(
            fresh,
            F.concat(lit("First Observed boost applied ["), F.col("firstseen_date").cast("string"), lit("].")),
        ),
        F.concat(lit("Score: "), number("score"), lit("/1000.")),
    ]
    return scored.withColumn("explanation", F.concat_ws(" ", *notes))


def score_compare(df: DataFrame, ours: str = "score", external: str = "external_score") -> DataFrame:
    return df.withColumn(
        "difference", F.coalesce(F.col(ours), F.lit(0)) - F.coalesce(F.col(external), F.lit(0))
    )


def score_history_of(history: DataFrame, indicator: str) -> DataFrame:
    return history.where(F.col("indicator") == indicator).orderBy(F.col("scoring_date").desc())


def score_changes_since(history: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """First and last score inside the window where they differ, largest change first."""
    recent = history.where(
        F.col("scoring_date") >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    )
    changed = recent.groupBy("indicator").agg(
        F.max_by("indicator_type", "scoring_date").alias("indicator_type"),
        F.min_by("score", "scoring_date").alias("previous_score"),
        F.max_by("score", "scoring_date").alias("current_score"),
        F.max("scoring_date").alias("last_updated"),
        F.count("*").alias("_n"),
    )
    out = changed.where("_n > 1 AND previous_score <> current_score").drop("_n")
    out = out.withColumn("change", F.col("current_score") - F.col("previous_score"))
    return out.orderBy(F.abs("change").desc(), "indicator")


def recurrence_risk(
    df: DataFrame, horizons: Sequence[int] = (1, 7, 14, 30, 45), scale: str = "share"
) -> DataFrame:
    """Score × probability per horizon, one decimal; ``scale='percent'`` for 0–100 inputs."""
    divisor = 100.0 if scale == "percent" else 1.0
    # halves go to the even digit, like the arrays this replaces
    return df.withColumns(
        {
            f"risk_{h}d": F.rint(F.col("score") * (F.col(f"probability_{h}") / divisor) * 10) / 10
            for h in horizons
        }
    )


def recurrence_risk_totals(df: DataFrame, horizons: Sequence[int] = (1, 7, 14, 30, 45)) -> DataFrame:
    names = [f"risk_{h}d" for h in horizons]
    one = df.agg(*[F.sum(c).alias(c) for c in names])
    return one.unpivot([], names, "horizon", "total").orderBy("horizon")


def actor_scores(df: DataFrame, actors: str = "actors", score: str = "score") -> DataFrame:
    """Per actor: indicators, distinct indicators, score statistics, severity of the mean."""
    rows = df.where(F.col(actors).isNotNull() & F.col(score).isNotNull()).select(
        F.explode(F.split(actors, r"\s*,\s*")).alias("actor"), "indicator", F.col(score).alias("s")
    )
    per_indicator = rows.groupBy("actor", "indicator").agg(
        F.count("*").alias("n"), F.sum("s").alias("total"), F.min("s").alias("low"), F.max("s").alias("high")
    )
    # integer scores from 0 to 1000, so the median's value map is small
    medians = rows.groupBy("actor").agg(F.percentile("s", F.lit(0.5)).alias("median_score"))
    out = per_indicator.groupBy("actor").agg(
        F.sum("n").alias("indicator_count"),
        F.count("*").alias("unique_indicators"),
        (F.sum("total") / F.sum("n")).alias("mean_score"),
        F.max("high").alias("max_score"),
        F.min("low").alias("min_score"),
    )
    return out.join(medians, "actor").withColumn("severity_of_mean", severity(F.col("mean_score")))


# fixed points lost per 30 idle days
DECAY = {"hash": 10, "domain": 25, "address": 40}


def score_decay(
    df: DataFrame, as_of: str, rates: Mapping[str, int] = DECAY, last_seen: str = "last_observed"
) -> DataFrame:
    """Lower the score for every full 30 days without a sighting, never below 0."""
    kind = F.col("indicator_type")
    rate = (
        F.when(kind.isin(*CONTINUITY[3]), rates["hash"])
        .when(kind.isin(*CONTINUITY[2]), rates["domain"])
        .when(kind.isin(*CONTINUITY[1]), rates["address"])
        .otherwise(0)
    )
    idle = F.greatest(F.datediff(F.lit(as_of).cast("date"), F.col(last_seen)), F.lit(0))
    decayed = F.greatest(F.col("score") - F.floor(idle / 30) * rate, F.lit(0))
    return df.withColumn("decayed_score", F.coalesce(decayed, F.col("score")).cast("int"))

