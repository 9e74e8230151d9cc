"""Queries of the aggregation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import aggregates as ag
from ..operators.joins import recency_range_join
from ..operators.timeseries import dense_panel, temporal_features
from .data import (
    AS_OF, observations, record_rows, records, score_rows, table, tag_dimension, tag_rows, text, with_tables,
)
from .q_timeseries import _F7, _F14, _STREAK, PANEL, W
from .registry import register
from .tidy import d, i, r, tidy

OBS, RECS, SCORES, DIM = (with_tables(t) for t in ("obs", "recs", "scores", "dim"))
TAGS = with_tables("recs", "tagrows")
SEV = "CASE WHEN score < 200 THEN 'low' WHEN score < 500 THEN 'medium' WHEN score < 800 THEN 'high' ELSE 'critical' END"
LEVELS = ("low", "medium", "high", "critical")


def joined(expression: str, sep: str = "|") -> str:
    """Sorted distinct values as text; nothing → null."""
    return f"string_agg(DISTINCT {expression}, '{sep}' ORDER BY {expression})"


@register("sources_per_indicator", f"{RECS} SELECT indicator, {joined('ownerName')} AS sources FROM recs GROUP BY 1")
def _(spark, sf):
    return tidy(ag.sources_per_indicator(record_rows(spark, sf)))


@register("condense_tags", f"""{DIM} SELECT indicator, {', '.join(f"{joined(c, ', ')} AS {c}" for c in ('tag', 'threat_category', 'nation_state', 'cve_nbr'))} FROM dim GROUP BY 1""")
def _(spark, sf):
    return ag.condense_tags(tag_dimension(spark, sf))


@register("condense_tags_category", f"{DIM} SELECT indicator, {joined('nation_state', ', ')} AS nation_state FROM dim WHERE threat_category = 'P' GROUP BY 1")
def _(spark, sf):
    return ag.condense_tags(tag_dimension(spark, sf), ("nation_state",), "P")


@register("tags_to_list", f"""{TAGS} SELECT r.id, coalesce(string_agg(t.name, '|' ORDER BY pos, part, supp), '') AS tag_list FROM recs r LEFT JOIN tagrows t ON r.id = t.id GROUP BY 1""")
def _(spark, sf):
    return tidy(ag.tags_to_list(records(spark, sf)), "id", "tag_list")


@register("botnet_tags", f"""{TAGS} SELECT r.id, coalesce(string_agg(t.name, '|' ORDER BY pos, part, supp) FILTER (WHERE lower(t.name) IN ('i&w', 'actor 3', 'actor 4')), '') AS botnet_tags FROM recs r LEFT JOIN tagrows t ON r.id = t.id GROUP BY 1""")
def _(spark, sf):
    out = ag.botnet_tags(ag.tags_to_list(records(spark, sf)), ("I&W", "Actor 3", "ACTOR 4"))
    return tidy(out, "id", "botnet_tags")


@register("tag_counts", f"""{TAGS} SELECT w.tag, count(t.id) AS n FROM (VALUES ('i&W'), ('ACTOR 3'), ('view splunk api'), ('absent')) AS w(tag) LEFT JOIN tagrows t ON lower(t.name) = lower(w.tag) GROUP BY 1""")
def _(spark, sf):
    return ag.tag_counts(records(spark, sf), ("i&W", "ACTOR 3", "view splunk api", "absent"))


@register("top_groups_by_type", f"""{TAGS}, n AS (SELECT group_type, group_name, count(*) AS n FROM tagrows GROUP BY ALL)
  SELECT *, row_number() OVER (PARTITION BY group_type ORDER BY n DESC, group_name) AS rank, CAST(sum(n) OVER (PARTITION BY group_type) AS BIGINT) AS type_total FROM n QUALIFY rank <= 5""")
def _(spark, sf):
    return tidy(ag.top_groups_by_type(records(spark, sf), 5))


@register("mass_scanner_flags", f"""{OBS} SELECT indicator, {i('sum(observations)')} AS total_obs, count(DISTINCT OpDiv) AS unique_partners, count(DISTINCT obs_date) AS unique_days,
  sum(observations) >= 1200 AND count(DISTINCT OpDiv) >= 5 AS mass_scanner FROM obs WHERE obs_date >= DATE '2024-01-23' GROUP BY 1""")
def _(spark, sf):
    return tidy(ag.mass_scanner_flags(observations(spark, sf), AS_OF, 7, 1200, 5))


@register("multi_partner", f"""{OBS} SELECT indicator, {joined('OpDiv')} AS partners, count(DISTINCT OpDiv) AS partner_count FROM obs WHERE obs_date >= DATE '2024-01-28'
  GROUP BY 1 HAVING count(DISTINCT OpDiv) >= 2""")
def _(spark, sf):
    return tidy(ag.multi_partner(observations(spark, sf), AS_OF, 2, 2))


_NAMED = """CASE WHEN name LIKE '% Splunk API' THEN replace(name, ' Splunk API', '') WHEN name IN ('I&W', 'actor 3') THEN name END"""


@register("partners_from_tags", f"""{TAGS} SELECT r.indicator, coalesce({joined(_NAMED)}, '') AS partners_from_tags FROM recs r JOIN tagrows t ON r.id = t.id GROUP BY 1""")
def _(spark, sf):
    return tidy(ag.partners_from_tags(records(spark, sf), ("I&W", "actor 3")))


@register("combine_partners", f"""{with_tables('recs', 'tagrows', 'obs', 'scores')}, p AS (SELECT indicator, OpDiv AS p FROM obs UNION
   SELECT r.indicator, replace(t.name, ' Splunk API', '') FROM recs r JOIN tagrows t ON r.id = t.id WHERE name LIKE '% Splunk API')
  SELECT s.indicator, coalesce({joined('p')}, '') AS partners, count(DISTINCT p) AS partner_count FROM scores s LEFT JOIN p ON s.indicator = p.indicator GROUP BY 1""")
def _(spark, sf):
    base = score_rows(spark, sf).select("indicator")
    return tidy(ag.combine_partners(base, records(spark, sf), observations(spark, sf)))


@register("first_non_null_record", f"""{RECS} SELECT indicator, {r('arg_min(rating, (-epoch(lastModified), id)) FILTER (WHERE rating IS NOT NULL)')} AS rating,
  {r('arg_min(confidence, (-epoch(lastModified), id)) FILTER (WHERE confidence IS NOT NULL)')} AS confidence, arg_min(ownerName, (-epoch(lastModified), id)) AS ownerName FROM recs GROUP BY 1""")
def _(spark, sf):
    newest = (-F.unix_timestamp("lastModified")).alias("t")
    out = ag.first_non_null_record(record_rows(spark, sf), "indicator", ("rating", "confidence", "ownerName"), (newest, "id"))
    return tidy(out)


_ENR = f"""{TAGS}, e AS (SELECT r.indicator, CASE WHEN pos % 2 = 0 THEN 'VirusTotal' ELSE 'Shodan' END AS type, CASE WHEN pos % 2 = 0 THEN part % 40 END AS vt,
   lower(group_name) || '.example' AS domain, group_type AS tag, CASE WHEN pos % 2 = 1 THEN 'C' || CAST(supp % 9 AS VARCHAR) END AS country FROM recs r JOIN tagrows t ON r.id = t.id)"""


@register("flatten_enrichment", f"""{_ENR} SELECT indicator, {joined('domain')} AS enrich_domains, {joined('tag')} AS enrich_tags, coalesce({joined('country')}, '') AS enrich_country,
  max(vt) AS "enrich_vtMaliciousCount" FROM e GROUP BY 1""")
def _(spark, sf):
    return tidy(ag.flatten_enrichment(records(spark, sf)).drop("part"))


@register("pivot_enrichment", f"""{_ENR} SELECT indicator, max(vt) FILTER (WHERE type = 'VirusTotal') AS vt_count, max(country) FILTER (WHERE type = 'Shodan') AS country FROM e GROUP BY 1""")
def _(spark, sf):
    spec = {"vt_count": ("VirusTotal", "vtMaliciousCount"), "country": ("Shodan", "country")}
    return ag.pivot_enrichment(records(spark, sf), spec)


@register("domain_fanout", f"{_ENR} SELECT domain, count(DISTINCT indicator) AS indicator_count FROM e GROUP BY 1")
def _(spark, sf):
    rows = records(spark, sf).select("indicator", F.flatten(F.transform("enrichment", lambda e: e["domains"])).alias("domains"))
    return ag.domain_fanout(rows)


@register("observed_days", f"{OBS} SELECT indicator, count(DISTINCT obs_date) AS obs_days FROM obs WHERE obs_date >= DATE '2024-01-10' GROUP BY 1")
def _(spark, sf):
    return tidy(ag.observed_days(observations(spark, sf), AS_OF, 20))


@register("duplicate_expansion", f"""{OBS}, c AS (SELECT indicator, count(*) AS occurrences FROM obs GROUP BY 1) SELECT indicator, occurrences, unnest(generate_series(1, occurrences)) AS copy FROM c""")
def _(spark, sf):
    return tidy(ag.occurrence_expansion(observations(spark, sf), "indicator"))


@register("daily_counts", f"""{OBS}, c AS (SELECT indicator, obs_date, count(*) AS n FROM obs GROUP BY ALL),
  g AS (SELECT indicator, CAST(unnest(generate_series(min(obs_date), DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS dt FROM obs GROUP BY 1)
  SELECT g.indicator, {d('g.dt')} AS date, coalesce(c.n, 0) AS n FROM g LEFT JOIN c ON g.indicator = c.indicator AND g.dt = c.obs_date""")
def _(spark, sf):
    return tidy(ag.daily_counts(observations(spark, sf), "indicator", "obs_date", AS_OF))


@register("top_k_pivot", f"""{OBS}, k AS (SELECT indicator, row_number() OVER (ORDER BY sum(observations) DESC, indicator) AS slot FROM obs GROUP BY 1 QUALIFY slot <= 10)
  SELECT {d('obs_date')} AS obs_date, {', '.join(f"CAST(coalesce(sum(observations) FILTER (WHERE slot = {n}), 0) AS BIGINT) AS top_{n}" for n in range(1, 11))}
  FROM obs JOIN k ON obs.indicator = k.indicator GROUP BY 1""")
def _(spark, sf):
    return tidy(ag.top_k_pivot(observations(spark, sf), "indicator", "obs_date", "observations", 10))


_DESC = f"""count(score) AS count, round(avg(score), 2) AS mean, round(quantile_cont(score, 0.5), 2) AS median, round(stddev_samp(score), 2) AS std,
  {i('min(score)')} AS min, {i('max(score)')} AS max"""


@register("describe_group", f"{SCORES} SELECT actor, {_DESC} FROM scores GROUP BY 1")
def _(spark, sf):
    return tidy(ag.describe_group(score_rows(spark, sf), "actor", "score"))


@register("describe_partners", f"{SCORES}, p AS (SELECT unnest(partners) AS partner, score FROM scores) SELECT partner, {_DESC} FROM p GROUP BY 1")
def _(spark, sf):
    return tidy(ag.describe_partners(score_rows(spark, sf)))


_MS = ("observations", "seen_streak", "volatility_ratio", "obs_ratio_spike", "seen_ratio_diff", "rolling_seen_ratio_7d", "rolling_obs_7d")
_STATS = (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min"))


def _shown(e: str) -> str:
    """The spike ratio reaches tens of millions, so it is compared in whole numbers."""
    return f"(round({e}, 0) + 0.0)" if "spike" in e else r(e)


@register("multi_stat_features", f"""{PANEL}, {_STREAK},
  t AS (SELECT *, coalesce(ratio - lag(ratio, 7) {W}), 0) AS seen_ratio_diff, o14 / (o7 + 1e-6) AS obs_ratio_spike, coalesce(sd / (ratio + 1e-5), 0) AS volatility_ratio, o7 AS rolling_obs_7d, r7 AS rolling_seen_ratio_7d
    FROM (SELECT *, avg(seen) {_F14} AS ratio, stddev_samp(seen) {_F14} AS sd, avg(observations) {_F14} AS o14, avg(observations) {_F7} AS o7, avg(seen) {_F7} AS r7 FROM streak)),
  g AS (SELECT indicator, {', '.join(f"coalesce({fn}({c}), 0) AS {c}_{nm}" for c in _MS for nm, fn in _STATS)} FROM t GROUP BY 1)
  SELECT indicator, {', '.join(f"{_shown(f'{c}_{nm}')} AS {c}_{nm}" for c in _MS for nm, _ in _STATS)}, {r('seen_streak_mean * volatility_ratio_mean')} AS streak_volatility,
  {_shown('obs_ratio_spike_mean - seen_ratio_diff_mean')} AS obs_spike_diff, {r('rolling_seen_ratio_7d_mean / (rolling_obs_7d_mean + 1e-6)')} AS rolling_ratio_diff FROM g""")
def _(spark, sf):
    rows = temporal_features(dense_panel(observations(spark, sf), AS_OF))
    out = ag.multi_stat_features(rows, "indicator", _MS)
    cols = [c for c in out.columns if c != "indicator"]
    return tidy(out.select("indicator", *[F.round(F.col(c).cast("double"), 0 if "spike" in c else 6).alias(c) for c in cols]))


@register("score_distribution", f"""{SCORES} SELECT count(score) AS count, {r('avg(score)')} AS mean, {r('stddev_samp(score)')} AS std, {r('skewness(score)')} AS skew,
  {', '.join(f"{r(f'quantile_cont(score, {p / 100})')} AS p{p}" for p in (10, 25, 50, 75, 90, 95, 99))},
  {', '.join(f"{r(f'''count(*) FILTER (WHERE {SEV} = '{v}') * 100.0 / count(score)''')} AS {v}_pct" for v in LEVELS)} FROM scores""")
def _(spark, sf):
    return tidy(ag.score_distribution(score_rows(spark, sf)))


@register("ecdf", f"{SCORES} SELECT indicator, {i('score')} AS score, row_number() OVER (ORDER BY score, indicator) AS rank, {r('row_number() OVER (ORDER BY score, indicator) / (SELECT count(*) FROM scores)')} AS share FROM scores")
def _(spark, sf):
    return tidy(ag.ecdf(score_rows(spark, sf), "score"))


@register("partner_severity_crosstab", f"""{SCORES}, s AS (SELECT actor, {SEV} AS sev FROM scores) SELECT actor, {', '.join(f"count(*) FILTER (WHERE sev = '{v}') AS {v}" for v in LEVELS)}, count(*) AS total FROM s GROUP BY 1""")
def _(spark, sf):
    df = score_rows(spark, sf).withColumn("severity", fx.severity(F.col("score")))
    return tidy(ag.partner_severity_crosstab(df, "actor", "severity"))


_TIERS = f"""{SCORES}, rk AS (SELECT *, row_number() OVER (ORDER BY score DESC, indicator) AS rn, count(*) OVER () AS n FROM scores)"""


@register("over_representation", f"""{_TIERS}, e AS (SELECT unnest(CASE WHEN len(partners) > 0 THEN partners ELSE ['No Partner'] END) AS partner, rn <= ceil(n * 0.1) AS t10, rn <= ceil(n * 0.05) AS t5 FROM rk),
  c AS (SELECT partner, count(*) AS overall, count(*) FILTER (WHERE t10) AS top10, count(*) FILTER (WHERE t5) AS top5 FROM e GROUP BY 1),
  p AS (SELECT *, overall * 100.0 / sum(overall) OVER () AS op, top10 * 100.0 / sum(top10) OVER () AS p10, top5 * 100.0 / sum(top5) OVER () AS p5 FROM c)
  SELECT partner, overall, top10, top5, {r('op')} AS overall_pct, {r('p10')} AS top10_pct, {r('p5')} AS top5_pct, {r('p10 - op')} AS top10_over, {r('p5 - op')} AS top5_over FROM p""")
def _(spark, sf):
    return tidy(ag.over_representation(score_rows(spark, sf)))


@register("actor_partner_reach", f"""{SCORES}, p AS (SELECT actor, unnest(partners) AS partner FROM scores UNION ALL SELECT 'A' || CAST(CAST(indicator AS BIGINT) % 30 AS VARCHAR), unnest(partners) FROM scores)
  SELECT actor, {joined('partner')} AS partners, count(DISTINCT partner) AS partner_count FROM p GROUP BY 1""")
def _(spark, sf):
    second = F.concat(F.lit(" A"), text(F.col("indicator").cast("long") % 30))
    return tidy(ag.actor_partner_reach(score_rows(spark, sf).withColumn("actors", F.array("actor", second))))


def _reports(spark, sf):
    """Daily report rows: one per sighting, with percent texts and labels."""
    o = F.col("observations")
    return observations(spark, sf).select(
        "indicator", F.col("OpDiv").alias("Partner"), F.col("obs_date").alias("FileDate"), o.alias("Frequency (7d)"),
        F.when(o % 11 != 0, F.concat(text(o % 100), F.lit("%"))).otherwise("unknown").alias("Probability: 7-Day"),
        F.concat(text(o % 50), F.lit(".5%")).alias("Probability: 14-Day"),
        F.concat(text(o % 70), F.lit("%")).alias("Probability: 30-Day"),
        F.element_at(F.array(*map(F.lit, ("Highly likely", "Possibly active", "Low confidence"))), (o % 3 + 1).cast("int")).alias("Confidence: 7-Day"),
    )


_REP = f"""{OBS}, rep AS (SELECT indicator, OpDiv, obs_date, observations AS o, CASE WHEN observations % 11 <> 0 THEN observations % 100 END::DOUBLE AS p7, observations % 50 + 0.5::DOUBLE AS p14, (observations % 70)::DOUBLE AS p30,
   ['Highly likely', 'Possibly active', 'Low confidence'][observations % 3 + 1] AS conf FROM obs)"""


@register("actor_recurrence", f"""{_REP}, c AS (SELECT indicator, avg(p7) AS a, avg(p14) AS b, avg(p30) AS c FROM rep GROUP BY 1),
  t AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS indicator, c_mktsegment AS actor FROM customer)
  SELECT actor, count(*) AS indicators, {r('avg(a)')} AS mean_7, {r('avg(b)')} AS mean_14, {r('avg(c)')} AS mean_30 FROM t JOIN c ON t.indicator = c.indicator GROUP BY 1""")
def _(spark, sf):
    tags = score_rows(spark, sf).select("indicator", "actor")
    return tidy(ag.actor_recurrence(_reports(spark, sf), tags))


@register("ranked_mode", f"""{_REP}, c AS (SELECT indicator, conf, count(*) AS n, CASE conf WHEN 'Highly likely' THEN 3 WHEN 'Possibly active' THEN 2 ELSE 1 END AS rk FROM rep GROUP BY ALL)
  SELECT indicator, arg_max(conf, (n, rk)) AS "Confidence: 7-Day" FROM c GROUP BY 1""")
def _(spark, sf):
    ranks = {"Highly likely": 3, "Possibly active": 2, "Low confidence": 1}
    return ag.ranked_mode(_reports(spark, sf), "indicator", "Confidence: 7-Day", ranks)


@register("daily_report_rollup", f"""{_REP}, m AS (SELECT indicator, arg_max(conf, (n, -rk)) AS conf FROM (SELECT indicator, conf, count(*) AS n, CASE conf WHEN 'Highly likely' THEN 1 WHEN 'Low confidence' THEN 2 ELSE 3 END AS rk FROM rep GROUP BY ALL) GROUP BY 1)
  SELECT rep.indicator, round(avg(o), 2) AS "Frequency (7d) (Average)", coalesce(printf('%.2f', avg(p7)) || '%', 'unknown') AS "Probability: 7-Day (Average)",
  any_value(m.conf) AS "Confidence: 7-Day (Mode)", arg_min(OpDiv, (obs_date, OpDiv)) AS "Partner (First)" FROM rep JOIN m ON rep.indicator = m.indicator GROUP BY 1""")
def _(spark, sf):
    return ag.daily_report_rollup(
        _reports(spark, sf), ("Frequency (7d)",), ("Probability: 7-Day",), ("Confidence: 7-Day",), ("Partner",), key="indicator",
    )


@register("median_impute_by_key", f"""{RECS}, m AS (SELECT indicator, quantile_cont(rating, 0.5) AS r, quantile_cont(confidence, 0.5) AS c FROM recs GROUP BY 1)
  SELECT id, {r('coalesce(rating, r, (SELECT quantile_cont(rating, 0.5) FROM recs))')} AS rating, {r('coalesce(confidence, c, (SELECT quantile_cont(confidence, 0.5) FROM recs))')} AS confidence
  FROM recs JOIN m ON recs.indicator = m.indicator""")
def _(spark, sf):
    out = ag.median_impute_by_key(record_rows(spark, sf).select("id", "indicator", "rating", "confidence"), "indicator", ("rating", "confidence"))
    return tidy(out, "id", "rating", "confidence")


_COLS = ("old_score", "vt_count", "confidence", "rating")


@register("correlations", f"""{SCORES} {' UNION ALL '.join(f"SELECT '{c}' AS feature, {r(f'corr({c}, score)')} AS correlation FROM scores" for c in _COLS)}""")
def _(spark, sf):
    return tidy(ag.correlations(score_rows(spark, sf), "score", _COLS))


@register("correlation_matrix", f"""{SCORES} {' UNION ALL '.join(f'''SELECT '{a}' AS "left", '{b}' AS "right", {r(f'corr({a}, {b})')} AS corr FROM scores''' for a in ('score', 'old_score', 'rating') for b in ('score', 'old_score', 'rating'))}""")
def _(spark, sf):
    return tidy(ag.correlation_matrix(score_rows(spark, sf), ("score", "old_score", "rating")))


def _share(cond: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) AS {name}_count, {r(f'count(*) FILTER (WHERE {cond}) * 100.0 / count(*)')} AS {name}_pct"


@register("score_shift_summary", f"""{SCORES}, x AS (SELECT score - old_score AS d FROM scores) SELECT count(*) AS n, {r('avg(d)')} AS mean, {r('quantile_cont(d, 0.5)')} AS median, {r('stddev_samp(d)')} AS std,
  {i('min(d)')} AS min, {i('max(d)')} AS max, {_share('d > 0', 'improved')}, {_share('d = 0', 'unchanged')}, {_share('d < 0', 'degraded')},
  {r('coalesce(avg(d) FILTER (WHERE d > 0), 0)')} AS mean_improvement, {r('abs(coalesce(avg(d) FILTER (WHERE d < 0), 0))')} AS mean_degradation,
  {_share('d >= 100', 'large_up')}, {_share('d <= -100', 'large_down')} FROM x""")
def _(spark, sf):
    return tidy(ag.score_shift_summary(score_rows(spark, sf), "old_score", "score"))


@register("landscape_summary", f"""{SCORES}, q AS (SELECT quantile_cont(score, [0.25, 0.75, 0.9, 0.95]) AS q FROM scores),
  a AS (SELECT count(*) AS total, min(last_observed) AS f, max(last_observed) AS l, quantile_cont(score, 0.5) AS median, avg(score) AS mean, stddev_samp(score) AS std, min(score) AS mn, max(score) AS mx,
    skewness(score) AS skew, avg(len(partners)) AS mp, max(len(partners)) AS xp, count(*) FILTER (WHERE len(partners) = 0) * 100.0 / count(*) AS p0, count(*) FILTER (WHERE len(partners) = 1) * 100.0 / count(*) AS p1,
    count(*) FILTER (WHERE len(partners) > 1) * 100.0 / count(*) AS p2, count(*) FILTER (WHERE score <= q[1]) AS lo, count(*) FILTER (WHERE score > q[1] AND score <= q[2]) AS me, count(*) FILTER (WHERE score > q[2]) AS hi,
    any_value(q) AS q FROM scores, q)
  SELECT total, {d('f')} AS first_day, {d('l')} AS last_day, {r('median')} AS median, {r('mean')} AS mean, {r('std')} AS std, {i('mn')} AS min, {i('mx')} AS max, {r('skew')} AS skew, {r('mp')} AS mean_partners,
  {i('xp')} AS max_partners, {r('p0')} AS no_partner_pct, {r('p1')} AS one_partner_pct, {r('p2')} AS multi_partner_pct, lo AS low_count, me AS medium_count, hi AS high_count,
  CASE WHEN skew > 0.5 THEN 'right-skewed' WHEN skew < -0.5 THEN 'left-skewed' ELSE 'balanced' END AS score_trend,
  CASE WHEN p2 > 40 THEN 'high multi-partner involvement' WHEN p0 > 50 THEN 'low partner involvement' ELSE 'balanced partner engagement' END AS partner_trend,
  CASE WHEN q[4] - q[3] > 20 THEN 'clear tier separation' ELSE 'compressed high end' END AS tier_trend,
  CASE WHEN median > 75 THEN 'HIGH' WHEN median > 60 THEN 'MODERATE-HIGH' WHEN median < 40 THEN 'LOW-MODERATE' ELSE 'MODERATE' END AS risk_level FROM a""")
def _(spark, sf):
    return tidy(ag.landscape_summary(score_rows(spark, sf)))


@register("recent_activity", f"""{SCORES}, a AS (SELECT score, DATE '2024-01-30' - last_observed AS age FROM scores)
  SELECT p AS period, count(*) AS count, {r('count(*) * 100.0 / (SELECT count(*) FROM scores)')} AS pct, {r('avg(score)')} AS mean, {r('quantile_cont(score, 0.5)')} AS median
  FROM a JOIN (VALUES ('0-7 Days', 7, -1), ('8-14 Days', 14, 7), ('15-21 Days', 21, 14), ('22-30 Days', 30, 21)) AS v(p, x, y) ON age <= x AND age > y GROUP BY 1""")
def _(spark, sf):
    scores = score_rows(spark, sf)
    placed = recency_range_join(scores, AS_OF, "last_observed")
    return tidy(ag.recent_activity(placed, scores.agg(F.count("*")).scalar()))


@register("recency_counts", f"""{SCORES} SELECT count(*) AS total, {', '.join(f"count(*) FILTER (WHERE DATE '2024-01-30' - last_observed <= {n}) AS last_{n}" for n in (30, 60, 90))} FROM scores""")
def _(spark, sf):
    return tidy(ag.recency_counts(score_rows(spark, sf), AS_OF, "last_observed"))


_SIZE = "(abs(coalesce(score, 0)) + abs(coalesce(vt_count, 0)) + abs(coalesce(rating, 0)))"


@register("component_importance", f"""{SCORES} {' UNION ALL '.join(f"SELECT '{c}' AS component, {r(f'avg(abs(coalesce({c}, 0)) * 100.0 / {_SIZE})')} AS share_pct FROM scores WHERE {_SIZE} > 0" for c in ('score', 'vt_count', 'rating'))}""")
def _(spark, sf):
    return tidy(ag.component_importance(score_rows(spark, sf), ("score", "vt_count", "rating")))


@register("probability_groups", f"""{SCORES}, g AS (SELECT CASE WHEN confidence >= 75 THEN 'high' WHEN confidence <= 25 THEN 'low' ELSE 'medium' END AS probability_group, score, {SEV} AS sev FROM scores)
  SELECT probability_group, count(*) AS count, {r('avg(score)')} AS mean_score, {r('quantile_cont(score, 0.25)')} AS q25, {r('quantile_cont(score, 0.75)')} AS q75,
  {', '.join(f"{r(f'''count(*) FILTER (WHERE sev = '{v}') * 100.0 / count(*)''')} AS {v}_pct" for v in LEVELS)} FROM g GROUP BY 1""")
def _(spark, sf):
    return tidy(ag.probability_groups(score_rows(spark, sf), "confidence"))


@register("partner_tier_stats", f"""{_TIERS}, t AS (SELECT 'all' AS tier, len(partners) AS k FROM rk UNION ALL SELECT 'top_10', len(partners) FROM rk WHERE rn <= ceil(n * 0.1) UNION ALL SELECT 'top_5', len(partners) FROM rk WHERE rn <= ceil(n * 0.05))
  SELECT tier, count(*) AS count, {', '.join(f'count(*) FILTER (WHERE {c}) AS "{nm}", {r(f"count(*) FILTER (WHERE {c}) * 100.0 / count(*)")} AS "{nm}_pct"' for nm, c in (('none', 'k = 0'), ('single', 'k = 1'), ('multiple', 'k >= 2')))},
  {r('avg(k)')} AS mean_partners, {r('(avg(k) - (SELECT avg(len(partners)) FROM scores)) / (SELECT avg(len(partners)) FROM scores) * 100')} AS lift_pct FROM t GROUP BY 1""")
def _(spark, sf):
    return tidy(ag.partner_tier_stats(score_rows(spark, sf)))


@register("partner_drift", f"""{with_tables('scores', 'obs')}, rc AS (SELECT indicator, list_sort(list(DISTINCT OpDiv)) AS p FROM obs WHERE obs_date >= DATE '2024-01-28' GROUP BY 1)
  SELECT s.indicator, array_to_string(s.partners, '|') AS all_time_partners, array_to_string(p, '|') AS recent_partners, {i('len(s.partners)')} AS all_time_count, {i('coalesce(len(p), 0)')} AS recent_count,
  array_to_string(coalesce(p, s.partners), '|') AS partners FROM scores s LEFT JOIN rc ON s.indicator = rc.indicator""")
def _(spark, sf):
    return tidy(ag.partner_drift(score_rows(spark, sf), observations(spark, sf), AS_OF, 2))


@register("available_tags", f"{with_tables('tagrows')} SELECT DISTINCT trim(name) AS name FROM tagrows WHERE trim(name) <> ''")
def _(spark, sf):
    return ag.available_tags(tag_rows(spark, sf), "name")


@register("value_shares", f"SELECT o_orderpriority, count(*) AS n, {r('count(*) * 100.0 / (SELECT count(*) FROM orders)')} AS share_pct FROM orders GROUP BY 1")
def _(spark, sf):
    return tidy(ag.value_shares(table(spark, sf, "orders"), "o_orderpriority"))
