"""Queries of the scoring operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scoring as sc
from ..plans.scoring import score_job
from .data import AS_OF, observations, records, score_inputs, score_rows, tag_dimension, text, with_tables
from .registry import register
from .tidy import d, i, r, tidy

PARTS = list(sc.COMPONENTS)
SEV = "CASE WHEN {s} < 200 THEN 'low' WHEN {s} < 500 THEN 'medium' WHEN {s} < 800 THEN 'high' ELSE 'critical' END"


def clip(e: str, lo: float, hi: float) -> str:
    return f"least(greatest(coalesce({e}, 0), {lo}), {hi})"


def score_sql(w: sc.Weights, tor: str = "tor_word", parity: bool = False, tables: str = with_tables("inputs")) -> str:
    """CTEs ``parts`` (components) and ``rated`` (rule score) for one set of weights."""
    file = "(indicator_type = 'File')" if w.file_rules else "false"
    rating_w = f"{w.rating}" if w.rating_without_vt is None else f"CASE WHEN vt_count IS NOT NULL THEN {w.rating} ELSE {w.rating_without_vt} END"
    known = "true" if w.missing_vt_is_zero else "vt_count IS NOT NULL"
    mass = f"(mass AND NOT {file} AND {str(w.mass_scanner_rules).lower()})"
    bonus = "CASE WHEN context_count >= 4 THEN 25.0 WHEN context_count = 3 THEN 15.0 WHEN context_count = 2 THEN 7.0 ELSE 0.0 END" if w.context_stack else "0.0"
    raw = " + ".join(PARTS)
    cap = f"({w.cap()!r} + CASE WHEN {file} THEN 900.0 ELSE 0.0 END)"
    quality = "1.0" if parity else clip("(1 + (rating IS NOT NULL)::INT + (confidence IS NOT NULL)::INT) / 3", 0.85, 1)
    return f"""{tables},
 v AS (SELECT *, CAST({clip('vt_count', 0, w.vt_max)} AS DOUBLE) AS vt, coalesce(vt_count >= 10 AND {tor}, false) AS boost FROM inputs),
 p0 AS (SELECT *, power(vt, {w.vt_exponent}) * {w.malicious} AS malicious,
   CASE WHEN {file} THEN 900.0 ELSE (CASE indicator_type WHEN 'Address' THEN 1.0 WHEN 'File' THEN 3.0 ELSE 2.0 END) * {w.continuity} END AS continuity,
   {clip('rating', 0, 5)} * ({rating_w}) AS rating_part, power(CAST({clip('confidence', 0, 100)} AS DOUBLE), {w.confidence_exponent}) * {w.confidence} AS confidence_part,
   CASE WHEN boost THEN {w.tor} * 2 WHEN {tor} THEN {w.tor} ELSE 0.0 END AS tor, CASE WHEN incident IS NOT NULL THEN {w.incident} ELSE 0.0 END AS incident_part,
   ln(greatest(sn, 1)) * {w.sources} AS sources_part, ln(greatest(pn, 1)) * {w.partners} AS partners_part,
   CASE WHEN actor IS NOT NULL THEN {w.actor} ELSE 0.0 END AS actor_part, {clip('cal_score', 0, 1000)} / 1000 * {w.cal} AS cal_part,
   {clip('external_score', 0, 1000)} / 1000 * {w.external} AS external_part,
   CASE WHEN first_seen IS NULL THEN 0.0 ELSE least(greatest((14 - (DATE '2024-01-30' - first_seen)) / 14, 0), 1) END * {w.first_seen} AS first_seen_part FROM v),
 p1 AS (SELECT *, (actor IS NOT NULL)::INT + (tor > 0)::INT + (incident IS NOT NULL)::INT + (sn >= 2)::INT + (pn >= 2)::INT AS context_count FROM p0),
 parts AS (SELECT *, {bonus} AS context_bonus, scanner AND indicator_type <> 'File' AS scans FROM p1),
 r0 AS (SELECT *, ({raw}) * {clip(f"1 - {w.observation_penalty} * (least(obs_days, 365) / 365)", 0.5, 1)} * {quality} * (CASE WHEN fp > 0 THEN 0.9 ELSE 1 END)
   * (CASE WHEN scans THEN {w.scanner_penalty} ELSE 1 END) * (CASE WHEN botnet AND NOT {file} THEN 0.4 ELSE 1 END) * (CASE WHEN {mass} THEN 0.05 ELSE 1 END) AS raw FROM parts),
 r1 AS (SELECT *, CAST(round_even(CAST(least(1000 * least(greatest(raw / {cap}, 0), 1) * {w.calibration}, 1000) AS DOUBLE), 0) AS INT) AS s1 FROM r0),
 r2 AS (SELECT *, CASE WHEN {known} AND vt <= 3 AND NOT boost THEN least(s1, 199) ELSE s1 END AS s2 FROM r1),
 r3 AS (SELECT *, CASE WHEN {known} AND vt >= 13 THEN greatest(s2, 499) ELSE s2 END AS s3 FROM r2),
 r4 AS (SELECT *, CASE WHEN botnet AND NOT {file} AND NOT boost THEN least(s3, 199) ELSE s3 END AS s4 FROM r3),
 r5 AS (SELECT *, CASE WHEN {mass} THEN least(s4, 199) ELSE s4 END AS s5 FROM r4),
 rated AS (SELECT *, CASE WHEN {file} THEN greatest(s5, 800) ELSE s5 END AS score, CASE WHEN {file} THEN 'critical' ELSE {SEV.format(s='s5')} END AS severity FROM r5)"""


V4 = sc.score_versions(4)
BASE = score_sql(V4)


for _name, _tor in (("score_components", "word"), ("score_components_substring", "substring")):
    def _query(spark, sf, tor=_tor):
        out = sc.score_components(score_inputs(spark, sf), AS_OF, tor_match=tor)
        return tidy(out, "indicator", *PARTS, "context_count")

    _sql = score_sql(V4, "tor_word" if _tor == "word" else "tor_sub")
    register(_name, f"{_sql} SELECT indicator, {', '.join(f'{r(c)} AS {c}' for c in PARTS)}, {i('context_count')} AS context_count FROM parts")(_query)


for _v in (1, 2, 3, 4):
    def _query(spark, sf, version=_v):
        weights = sc.score_versions(version)
        out = sc.score_rule(sc.score_components(score_inputs(spark, sf), AS_OF, weights), weights)
        return tidy(out, "indicator", "raw_score", "score", "severity")

    register(
        "score_rule" if _v == 4 else f"score_versions_{_v}",
        f"{score_sql(sc.score_versions(_v))} SELECT indicator, {r('raw')} AS raw_score, {i('score')} AS score, severity FROM rated",
    )(_query)


@register("score_rule_parity", f"{score_sql(V4, 'tor_sub', True)} SELECT indicator, {i('score')} AS score, severity FROM rated")
def _(spark, sf):
    parts = sc.score_components(score_inputs(spark, sf), AS_OF, tor_match="substring")
    return tidy(sc.score_rule(parts, parity=True), "indicator", "score", "severity")


_DRIVERS = "[" + ", ".join(
    f"{{'size': -abs({c}), 'pos': {n}, 'label': " + (f"CASE WHEN actor IS NOT NULL THEN 'Associated with ' || actor ELSE '{label}' END" if c == "actor_part" else f"'{label}'") + "}"
    for n, (c, label) in enumerate(sc.COMPONENTS.items())
) + "]"


_TOP = f"t AS (SELECT *, list_transform(list_filter(list_slice(list_sort({_DRIVERS}), 1, 3), lambda e: e.size <> 0), lambda e: e.label) AS top FROM rated)"
_TEXT = """concat_ws(' ', '[2024-01-30] Severity: ' || severity || '.', CASE WHEN vt_count IS NOT NULL THEN 'VT score: ' || CAST(CAST(vt AS INT) AS VARCHAR) || '.' ELSE 'VT score not available (neutral).' END,
  'Contextual Drivers: ' || CASE WHEN len(top) > 0 THEN array_to_string(top, '; ') ELSE 'No significant drivers' END || '.',
  CASE WHEN pn > 0 THEN 'Observed across ' || CAST(pn AS VARCHAR) || ' partner(s).' ELSE 'No partner attribution.' END,
  CASE WHEN sn > 1 THEN 'Observed by ' || CAST(sn AS VARCHAR) || ' sources: ' || sources || '.' ELSE 'Single source observation.' END,
  CASE WHEN context_count > 0 THEN CAST(context_count AS VARCHAR) || ' reinforcing context signal(s).' ELSE 'No reinforcing context stack.' END,
  CASE WHEN botnet AND indicator_type <> 'File' THEN 'Botnet penalty applied.' ELSE 'No botnet penalty.' END,
  CASE WHEN fp > 0 THEN CAST(fp AS VARCHAR) || ' false positive tag(s).' ELSE 'No false positive tags.' END,
  CASE WHEN scans THEN 'Scanner penalty applied.' ELSE 'No scanner penalty.' END, CASE WHEN tor > 0 THEN 'TOR activity detected.' ELSE 'No TOR activity.' END,
  CASE WHEN incident IS NOT NULL THEN 'Linked to incident/event: ' || incident || '.' ELSE 'No incident/event link.' END,
  CASE WHEN actor IS NOT NULL THEN 'Associated threat actor(s): ' || actor || '.' END, CASE WHEN first_seen_part > 0 THEN 'First Observed boost applied [' || CAST(first_seen AS VARCHAR) || '].' END,
  'Score: ' || CAST(score AS VARCHAR) || '/1000.')"""


@register("score_explanation", f"{BASE}, {_TOP} SELECT indicator, {_TEXT} AS explanation FROM t")
def _(spark, sf):
    out = sc.score_rule(sc.score_components(score_inputs(spark, sf), AS_OF))
    return sc.score_explanation(out, AS_OF).select("indicator", "explanation")


def first(c: str) -> str:
    return f"arg_min({c}, (-epoch(lastModified), id)) FILTER (WHERE {c} IS NOT NULL)"


# the whole job from records, tags and sightings
_JOB = f"""{with_tables('obs', 'recs', 'tagrows', 'dim')},
 b AS (SELECT indicator, any_value(type) AS indicator_type, {first('rating')} AS rating, {first('confidence')} AS confidence, {first('cal')} AS cal_score, {first('ext')} AS external_score,
   {first('falsePositives')} AS fp, min(CAST(dateAdded AS DATE)) AS first_seen, count(DISTINCT ownerName) AS sn, string_agg(DISTINCT ownerName, ', ' ORDER BY ownerName) AS sources FROM recs GROUP BY 1),
 rt AS (SELECT r.indicator, t.* EXCLUDE (id) FROM recs r JOIN tagrows t ON r.id = t.id),
 tg AS (SELECT indicator, bool_or(name LIKE 'TOR %') AS tor_word, bool_or(lower(name) LIKE '%tor%') AS tor_sub, string_agg(DISTINCT 'Incident:' || group_id, ';' ORDER BY 'Incident:' || group_id) FILTER (WHERE group_type = 'Incident') AS incident,
   max(part % 40) FILTER (WHERE pos % 2 = 0) AS vt_count FROM rt GROUP BY 1),
 ac AS (SELECT indicator, string_agg(DISTINCT nation_state, ', ' ORDER BY nation_state) AS actor FROM dim GROUP BY 1),
 ob AS (SELECT indicator, count(DISTINCT obs_date) AS obs_days, coalesce(sum(observations) FILTER (WHERE obs_date >= DATE '2024-01-23') >= 1200 AND count(DISTINCT OpDiv) FILTER (WHERE obs_date >= DATE '2024-01-23') >= 5, false) AS mass FROM obs GROUP BY 1),
 pt AS (SELECT indicator, count(DISTINCT p) AS pn FROM (SELECT indicator, OpDiv AS p FROM obs UNION ALL SELECT indicator, replace(name, ' Splunk API', '') FROM rt WHERE name LIKE '% Splunk API') GROUP BY 1),
 inputs AS (SELECT b.*, coalesce(pn, 0) AS pn, actor, incident, vt_count, coalesce(obs_days, 0) AS obs_days, coalesce(tor_word, false) AS tor_word, coalesce(tor_sub, false) AS tor_sub, false AS scanner, false AS botnet, coalesce(mass, false) AS mass
   FROM b LEFT JOIN tg ON b.indicator = tg.indicator LEFT JOIN ac ON b.indicator = ac.indicator LEFT JOIN ob ON b.indicator = ob.indicator LEFT JOIN pt ON b.indicator = pt.indicator)"""


@register("score_job", f"{score_sql(V4, tables=_JOB)}, {_TOP} SELECT indicator, {i('score')} AS score, severity, {_TEXT} AS explanation FROM t")
def _(spark, sf):
    out = score_job(
        records(spark, sf), observations(spark, sf), tag_dimension(spark, sf), AS_OF, min_total=1200, min_partners=5
    )
    return tidy(out, "indicator", "score", "severity", "explanation")


@register("score_versions", " UNION ALL ".join(
    f"(SELECT {v} AS version, * FROM ({score_sql(sc.score_versions(v))} SELECT indicator, {i('score')} AS score, severity FROM rated))" for v in (1, 2, 3, 4)
))
def _(spark, sf):
    out = None
    for v in (1, 2, 3, 4):
        weights = sc.score_versions(v)
        rows = sc.score_rule(sc.score_components(score_inputs(spark, sf), AS_OF, weights), weights)
        rows = rows.select(F.lit(v).alias("version"), "indicator", F.col("score").cast("long").alias("score"), "severity")
        out = rows if out is None else out.unionByName(rows)
    return out


SCORES = with_tables("scores")


@register("score_compare", f"{with_tables('scores')} SELECT indicator, {i('score - old_score')} AS difference FROM scores")
def _(spark, sf):
    return tidy(sc.score_compare(score_rows(spark, sf), "score", "old_score"), "indicator", "difference")


def _history(spark, sf):
    """Daily score of every indicator: the day's sightings capped at 1000."""
    days = observations(spark, sf).groupBy("indicator", F.col("obs_date").cast("timestamp").alias("scoring_date")).agg(
        F.least(F.sum("observations"), F.lit(1000)).cast("int").alias("score")
    )
    return days.withColumn("indicator_type", F.lit("Address"))


_HIST = f"{with_tables('obs')}, h AS (SELECT indicator, obs_date, CAST(least(sum(observations), 1000) AS INT) AS score FROM obs GROUP BY ALL)"


@register("score_history_of", f"{_HIST} SELECT indicator, {d('obs_date')} AS scoring_date, {i('score')} AS score FROM h WHERE indicator = '7'")
def _(spark, sf):
    return tidy(sc.score_history_of(_history(spark, sf), "7"), "indicator", "scoring_date", "score")


@register("score_changes_since", f"""{_HIST}, c AS (SELECT indicator, arg_min(score, obs_date) AS a, arg_max(score, obs_date) AS b, max(obs_date) AS u FROM h WHERE obs_date >= DATE '2024-01-23' GROUP BY 1 HAVING count(*) > 1)
  SELECT indicator, 'Address' AS indicator_type, {i('a')} AS previous_score, {i('b')} AS current_score, {d('u')} AS last_updated, {i('b - a')} AS change FROM c WHERE a <> b""")
def _(spark, sf):
    return tidy(sc.score_changes_since(_history(spark, sf), AS_OF, 7))


def _risk(spark, sf):
    rows = score_rows(spark, sf)
    for n, h in enumerate((1, 7, 14, 30, 45)):
        rows = rows.withColumn(f"probability_{h}", F.col("confidence") * (n + 1) / 5)
    return sc.recurrence_risk(rows, scale="percent")


_RISK = f"""{SCORES}, k AS (SELECT indicator, {', '.join(f"round_even(score * (confidence * {n + 1} / 5 / 100.0) * 10, 0) / 10 AS risk_{h}d" for n, h in enumerate((1, 7, 14, 30, 45)))} FROM scores)"""
_RISKS = [f"risk_{h}d" for h in (1, 7, 14, 30, 45)]


@register("recurrence_risk", f"{_RISK} SELECT indicator, {', '.join(f'{r(c)} AS {c}' for c in _RISKS)} FROM k")
def _(spark, sf):
    return tidy(_risk(spark, sf), "indicator", *_RISKS)


@register("recurrence_risk_totals", f"{_RISK} " + " UNION ALL ".join(f"SELECT '{c}' AS horizon, {r(f'sum({c})')} AS total FROM k" for c in _RISKS))
def _(spark, sf):
    return tidy(sc.recurrence_risk_totals(_risk(spark, sf)))


@register("actor_scores", f"""{SCORES}, a AS (SELECT indicator, score, unnest([actor, 'A' || CAST(CAST(indicator AS BIGINT) % 20 AS VARCHAR)]) AS actor FROM scores)
  SELECT actor, count(*) AS indicator_count, count(DISTINCT indicator) AS unique_indicators, {r('avg(score)')} AS mean_score, {r('quantile_cont(score, 0.5)')} AS median_score,
  {i('max(score)')} AS max_score, {i('min(score)')} AS min_score, {SEV.format(s='avg(score)')} AS severity_of_mean FROM a GROUP BY 1""")
def _(spark, sf):
    second = F.concat(F.lit("A"), text(F.col("indicator").cast("long") % 20))
    return tidy(sc.actor_scores(score_rows(spark, sf).withColumn("actors", F.concat_ws(", ", "actor", second))))


@register("score_decay", f"""{SCORES} SELECT indicator, {i('''greatest(score - floor((DATE '2024-01-30' - last_observed) / 30) * (CASE indicator_type WHEN 'File' THEN 10 WHEN 'Address' THEN 40 ELSE 25 END), 0)''')} AS decayed_score FROM scores""")
def _(spark, sf):
    return tidy(sc.score_decay(score_rows(spark, sf), AS_OF), "indicator", "decayed_score")
