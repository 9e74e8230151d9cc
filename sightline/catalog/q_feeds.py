"""Queries of the selection feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import feeds
from .data import AS_OF, observations, record_rows, records, score_rows, table, tag_dimension, text, with_tables
from .q_aggregates import joined
from .registry import register
from .tidy import d, i, r, tidy

OBS, RECS, SCORES, DIM = (with_tables(t) for t in ("obs", "recs", "scores", "dim"))
NOW = "TIMESTAMP '2024-01-30'"


@register("top_n", f"{SCORES} SELECT indicator, {i('score')} AS score FROM scores ORDER BY score DESC, indicator LIMIT 10")
def _(spark, sf):
    return tidy(feeds.top_n(score_rows(spark, sf), "score", 10), "indicator", "score")


@register("top_n_absolute", f"{SCORES} SELECT indicator, {i('score - old_score')} AS change FROM scores ORDER BY abs(score - old_score) DESC, indicator LIMIT 20")
def _(spark, sf):
    df = score_rows(spark, sf).withColumn("change", F.col("score") - F.col("old_score"))
    return tidy(feeds.top_n(df, "change", 20, absolute=True), "indicator", "change")


@register("top_n_per_group", """WITH c AS (SELECT l_returnflag, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)
  SELECT l_returnflag, l_suppkey, n, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_suppkey) AS rank FROM c QUALIFY rank <= 5""")
def _(spark, sf):
    return tidy(feeds.top_n_per_group(table(spark, sf, "lineitem"), "l_returnflag", "l_suppkey", 5))


@register("ordered_lookup", f"""{SCORES} SELECT s.indicator, {i('score')} AS score, {i('s_nationkey')} AS position FROM scores s JOIN supplier ON s.indicator = CAST(s_suppkey AS VARCHAR)""")
def _(spark, sf):
    keys = table(spark, sf, "supplier").select(text("s_suppkey").alias("indicator"), F.col("s_nationkey").alias("position"))
    return tidy(feeds.ordered_lookup(score_rows(spark, sf).select("indicator", "score"), keys))


@register("union_feeds", f"""{with_tables('scores', 'recs')} SELECT indicator, actor, NULL::DOUBLE AS rating FROM scores UNION ALL SELECT indicator, NULL, rating FROM recs""")
def _(spark, sf):
    return feeds.union_feeds(score_rows(spark, sf).select("indicator", "actor"), record_rows(spark, sf).select("indicator", "rating"))


for _name, _sql in (("intersect_keys", "INTERSECT"), ("except_keys", "EXCEPT")):
    def _query(spark, sf, name=_name):
        scores = score_rows(spark, sf)
        return getattr(feeds, name)(scores, observations(spark, sf), "indicator")

    register(_name, f"{with_tables('scores', 'obs')} SELECT indicator FROM scores {_sql} SELECT indicator FROM obs")(_query)


_AGENCY = f"""{with_tables('obs', 'recs', 'tagrows', 'scores')},
 keep AS (SELECT r.id, arg_min(t.group_id, (pos, part, supp)) FILTER (WHERE length(t.group_id) = 16) AS gid, coalesce(bool_or(t.name = 'I&W'), false) AS iw,
    coalesce({joined("replace(t.name, ' Splunk API', '')")} FILTER (WHERE t.name LIKE '%API%'), '') AS tagp
   FROM recs r LEFT JOIN tagrows t ON r.id = t.id GROUP BY 1 HAVING NOT coalesce(bool_and(t.group_type = 'Adversary'), false)),
 ag AS (SELECT r.*, k.gid, k.iw, t.name, regexp_replace(t.name, '\\s+Splunk API$', '') AS OpDiv FROM recs r JOIN keep k ON r.id = k.id JOIN tagrows t ON r.id = t.id WHERE lower(t.name) LIKE '%api%')"""


@register("explode_agency_tags", f"{_AGENCY} SELECT id, indicator, name, OpDiv, gid AS group_id, {r('rating')} AS rating FROM ag")
def _(spark, sf):
    return tidy(feeds.explode_agency_tags(records(spark, sf)), "id", "indicator", "name", "OpDiv", "group_id", "rating")


_WARN = f"""{_AGENCY}, sg AS (SELECT indicator, OpDiv, max(obs_date) AS od FROM obs GROUP BY ALL),
 rc AS (SELECT ag.*, od FROM ag JOIN sg ON ag.indicator = sg.indicator AND ag.OpDiv = sg.OpDiv WHERE lastObserved >= {NOW} - INTERVAL 24 HOUR AND od >= DATE '2024-01-28'),
 pc AS (SELECT indicator, {joined('OpDiv')} AS partners, count(DISTINCT OpDiv) AS partner_count FROM rc GROUP BY 1),
 w AS (SELECT rc.*, partners, partner_count FROM rc JOIN pc ON rc.indicator = pc.indicator WHERE partner_count >= 2 AND observations < {{obs}} AND dateAdded >= {NOW} - to_days({{age}})),
 w1 AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY lastModified DESC, id, name) = 1)
 SELECT indicator, id, OpDiv, partners, partner_count, {i('observations')} AS observations, {d('od')} AS observed_date FROM w1 WHERE NOT iw"""

for _name, _obs, _age in (("warning_candidates", 40000, 360), ("warning_candidates_30d", 15000, 30)):
    def _query(spark, sf, max_obs=_obs, age=_age):
        out = feeds.warning_candidates(records(spark, sf), observations(spark, sf), AS_OF, max_obs, age)
        return tidy(out, "indicator", "id", "OpDiv", "partners", "partner_count", "observations", "observed_date")

    register(_name, _WARN.format(obs=_obs, age=_age))(_query)


@register("warning_candidates_expanded", f"""{_AGENCY}, sg AS (SELECT indicator, OpDiv, max(obs_date) AS od FROM obs GROUP BY ALL),
 mp AS (SELECT indicator, list(DISTINCT OpDiv) AS p FROM obs WHERE obs_date >= DATE '2024-01-28' GROUP BY 1 HAVING count(DISTINCT OpDiv) >= 2),
 w AS (SELECT ag.*, od, p FROM ag JOIN sg ON ag.indicator = sg.indicator AND ag.OpDiv = sg.OpDiv JOIN mp ON ag.indicator = mp.indicator WHERE od >= DATE '2024-01-28'),
 w1 AS (SELECT w.*, list_sort(list_distinct(list_concat(p, string_split(k.tagp, '|')))) AS ps FROM w JOIN keep k ON w.id = k.id QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY lastModified DESC, w.id, name) = 1)
 SELECT indicator, id, array_to_string(ps, '|') AS partners, {i('len(ps)')} AS partner_count, CASE WHEN iw THEN 'Yes' ELSE 'No' END AS reported FROM w1""")
def _(spark, sf):
    out = feeds.warning_candidates_expanded(records(spark, sf), observations(spark, sf), AS_OF)
    return tidy(out, "indicator", "id", "partners", "partner_count", "reported")


@register("report_groups", f"""{RECS}, x AS (SELECT indicator AS k, CASE WHEN description <> 'P' THEN 'g' || CAST(id % 4000 AS VARCHAR) END AS gid FROM recs),
 g AS (SELECT gid, {joined('k')} AS indicators, count(DISTINCT k) AS n, min(k) AS one FROM x WHERE gid IS NOT NULL GROUP BY 1)
 SELECT gid AS group_id, indicators, CASE WHEN n = 1 THEN one ELSE 'Group_' || gid END AS report FROM g UNION ALL SELECT DISTINCT NULL, k, k FROM x WHERE gid IS NULL""")
def _(spark, sf):
    group = F.when(F.col("description") != "P", F.concat(F.lit("g"), text(F.col("id") % 4000))).otherwise(" None ")
    df = record_rows(spark, sf).select(F.col("indicator").alias("search_term"), group.alias("group_id"))
    return tidy(feeds.report_groups(df).drop("part"))


@register("append_reported", f"{with_tables('scores', 'obs')} SELECT indicator FROM scores UNION SELECT indicator FROM obs")
def _(spark, sf):
    return feeds.append_reported(score_rows(spark, sf), observations(spark, sf))


@register("partner_tips", f"""{_AGENCY}, rc AS (SELECT ag.*, o.obs_date FROM ag JOIN (SELECT DISTINCT indicator, OpDiv, obs_date FROM obs WHERE obs_date >= DATE '2024-01-29') o ON ag.indicator = o.indicator AND ag.OpDiv = o.OpDiv WHERE lastObserved >= {NOW} - INTERVAL 1 DAY),
 vt AS (SELECT r.indicator, max(part % 40) FILTER (WHERE pos % 2 = 0) AS vt, max('C' || CAST(supp % 9 AS VARCHAR)) FILTER (WHERE pos % 2 = 1) AS country FROM recs r JOIN tagrows t ON r.id = t.id GROUP BY 1),
 one AS (SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY lastModified DESC, id, name) = 1),
 pc AS (SELECT indicator, {joined('OpDiv')} AS partners, unnest(list(DISTINCT OpDiv)) AS partner FROM rc GROUP BY 1)
 SELECT one.indicator, pc.partner, pc.partners, vt.vt AS vt_count, vt.country, {i('s.score')} AS score FROM one JOIN pc ON one.indicator = pc.indicator JOIN vt ON one.indicator = vt.indicator AND vt.vt > 10 LEFT JOIN scores s ON s.indicator = one.indicator""")
def _(spark, sf):
    out = feeds.partner_tips(records(spark, sf), observations(spark, sf), AS_OF, 10, score_rows(spark, sf))
    return tidy(out, "indicator", "partner", "partners", "vt_count", "country", "score")


def _sightings(spark, sf):
    """Observations, and every order as one more sighting of its customer."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        text("o_custkey").alias("indicator"), F.lit("0").alias("API_UserName"),
        F.date_sub(F.lit(AS_OF).cast("date"), (key % 5).cast("int")).alias("obs_date"),
        F.concat(F.lit("partner "), text(key % 4)).alias("OpDiv"), F.lit(1).cast("long").alias("observations"),
    )
    return observations(spark, sf).unionByName(orders)


@register("priority_feed", f"""{with_tables('obs', 'recs', 'tagrows', 'scores')}, tr AS (SELECT * FROM recs WHERE rating >= 3 AND confidence >= 50),
 nw AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY lastObserved DESC, id) = 1),
 gr AS (SELECT id, string_agg('Group Id: ' || group_id, ', ' ORDER BY pos, part, supp) AS g FROM tagrows GROUP BY 1),
 iw AS (SELECT DISTINCT tr.indicator FROM tr JOIN tagrows t ON tr.id = t.id WHERE t.name = 'I&W'),
 sg AS (SELECT indicator, OpDiv, obs_date FROM obs UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), 'partner ' || CAST(o_orderkey % 4 AS VARCHAR), DATE '2024-01-30' - CAST(o_orderkey % 5 AS INT) FROM orders),
 mp AS (SELECT indicator, {joined('OpDiv')} AS partners, count(DISTINCT OpDiv) AS pc FROM sg WHERE obs_date >= DATE '2024-01-29' GROUP BY 1 HAVING count(DISTINCT OpDiv) >= 2)
 SELECT s.indicator, {i('score')} AS score, CASE WHEN score < 800 THEN 'high' ELSE 'critical' END AS severity, mp.partners, pc AS partner_count, g AS associated_groups, CASE WHEN iw.indicator IS NULL THEN 'No' ELSE 'Yes' END AS reported
 FROM scores s JOIN nw ON s.indicator = nw.indicator AND lastObserved >= {NOW} - INTERVAL 48 HOUR JOIN mp ON s.indicator = mp.indicator LEFT JOIN gr ON nw.id = gr.id LEFT JOIN iw ON iw.indicator = s.indicator WHERE vt_count >= 14 AND score >= 500""")
def _(spark, sf):
    scores = score_rows(spark, sf).withColumn("severity", fx.severity(F.col("score")))
    out = feeds.priority_feed(records(spark, sf), scores, _sightings(spark, sf), AS_OF)
    return tidy(out, "indicator", "score", "severity", "partners", "partner_count", "associated_groups", "reported")


_SEARCHES = {
    "tag_search": (dict(terms=("urgent", "LOW")), "lower(tag) LIKE '%urgent%' OR lower(tag) LIKE '%low%'"),
    "tag_search_all": (dict(terms=("not", "SPEC"), mode="all"), "lower(tag) LIKE '%not%' AND lower(tag) LIKE '%spec%'"),
    "tag_search_exact": (dict(terms=("2-high",), match="exact"), "lower(tag) = '2-high'"),
    "tag_search_case": (dict(terms=("HIGH", "low"), case=True), "tag LIKE '%HIGH%' OR tag LIKE '%low%'"),
}
for _name, (_options, _where) in _SEARCHES.items():
    def _query(spark, sf, options=_options):
        return feeds.tag_search(tag_dimension(spark, sf), **options)

    register(_name, f"{DIM} SELECT * FROM dim WHERE {_where}")(_query)


@register("search_scores", f"""{with_tables('dim', 'scores')} SELECT indicator, {i('score')} AS score FROM scores WHERE indicator IN (SELECT indicator FROM dim WHERE lower(nation_state) LIKE '%ns3%')""")
def _(spark, sf):
    out = feeds.search_scores(tag_dimension(spark, sf), score_rows(spark, sf), ("NS3",), col="nation_state")
    return tidy(out, "indicator", "score")


_ISP = ("Vultr Holdings", "Amazon", "M247 Europe", "Small Town Net", "Leaseweb Google", "ATT Services", "lir.net", "lirxnet")
_COUNTRY = ("China", "North Korea", "France", "Brazil")


def _pick_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _network(spark, sf):
    key = F.col("s_suppkey")
    pick = lambda values, e: F.element_at(F.array(*map(F.lit, values)), (e % len(values) + 1).cast("int"))
    return table(spark, sf, "supplier").select(
        text(key).alias("indicator"), F.when(F.col("s_nationkey") == 5, "Host").otherwise("Address").alias("indicator_type"),
        pick(_ISP, key).alias("isp"), F.lit("Org").alias("org"), F.lit(None).cast("string").alias("asn_name"),
        pick(_COUNTRY, key + F.floor(key / 3)).alias("country"), (F.floor(key / 2) % 3 == 0).alias("proxy"), (F.floor(key / 5) % 2 == 0).alias("hosting"),
        (F.col("s_nationkey") % 4 + 396980).alias("asn"),
        F.when(key % 3 == 0, F.array(F.lit("Known Scanner PB"))).when(key % 3 == 1, F.array(F.lit("x"))).alias("tag_names"),
    )


_NET = f"""WITH net AS (SELECT CAST(s_suppkey AS VARCHAR) AS indicator, CASE WHEN s_nationkey = 5 THEN 'Host' ELSE 'Address' END AS indicator_type, {_pick_list(_ISP)}[s_suppkey % 8 + 1] AS isp,
   {_pick_list(_COUNTRY)}[(s_suppkey + CAST(floor(s_suppkey / 3) AS BIGINT)) % 4 + 1] AS country, floor(s_suppkey / 2) % 3 = 0 AS proxy, floor(s_suppkey / 5) % 2 = 0 AS hosting, s_nationkey % 4 + 396980 AS asn,
   s_suppkey % 3 AS k FROM supplier),
 f AS (SELECT *, lower(isp) || ' org ' AS c FROM net),
 g AS (SELECT *, regexp_matches(c, 'leaseweb|m247|vultr|lir\\.net') AS shady, regexp_matches(c, 'amazon|google|att ') AS cloud FROM f),
 t AS (SELECT *, shady AND NOT cloud AS b, hosting AND NOT shady AND cloud AS cl, hosting AND NOT shady AND NOT cloud AS ge, country IN ('China', 'North Korea') AS risky FROM g),
 tri AS (SELECT indicator, CASE WHEN indicator_type <> 'Address' THEN 'non_ip' WHEN cl THEN 'cloud_hosted' WHEN b THEN 'malicious_infrastructure' WHEN proxy THEN 'anonymized_traffic' WHEN ge THEN 'hosted_infrastructure' WHEN risky THEN 'unknown' ELSE 'insufficient_data' END AS behavior,
   CASE WHEN indicator_type <> 'Address' THEN '' ELSE concat_ws('; ', CASE WHEN b THEN 'bulletproof_hosting' END, CASE WHEN proxy THEN 'proxy_anonymizer' END, CASE WHEN cl THEN 'legitimate_cloud_hosting' END, CASE WHEN ge THEN 'generic_hosting' END, CASE WHEN risky THEN 'high_risk_country_' || replace(country, ' ', '_') END) END AS flags,
   CASE WHEN indicator_type <> 'Address' THEN 'manual_review' WHEN cl THEN 'reduce_score' WHEN b OR proxy THEN 'elevate_score' WHEN risky THEN 'analyst_review' ELSE 'no_change' END AS recommendation FROM t)"""


@register("triage_infrastructure", f"""{_NET} SELECT tri.*, CASE WHEN behavior = 'non_ip' THEN 'Non-IP type (Host). No automated triage available.'
  ELSE 'ISP: ' || isp || '. Org: Org. Country: ' || country || '. ASN: ' || asn || '. Proxy: ' || if(proxy, 'True', 'False') || '. Hosting: ' || if(hosting, 'True', 'False')
    || '. Behavior: ' || behavior || '. Recommendation: ' || recommendation || '.' END AS notes FROM tri JOIN net USING (indicator)""")
def _(spark, sf):
    return feeds.triage_infrastructure(_network(spark, sf)).select("indicator", "behavior", "flags", "recommendation", "notes")


@register("triage_summary", f"{_NET} SELECT behavior, recommendation, count(*) AS n FROM tri GROUP BY ALL")
def _(spark, sf):
    return feeds.triage_summary(feeds.triage_infrastructure(_network(spark, sf)))


@register("tag_by_asn", f"""{_NET} SELECT indicator, {i('asn')} AS asn, CASE WHEN k = 1 THEN 'x|Known Scanner PB' ELSE 'Known Scanner PB' END AS tag_names FROM net WHERE indicator_type = 'Address' AND asn IN (396982, 396983) AND k <> 0""")
def _(spark, sf):
    return tidy(feeds.tag_by_asn(_network(spark, sf), (396982, 396983)), "indicator", "asn", "tag_names")


_RULES = (("agency", ("View Splunk API",), ("error",)), ("actors", (), ("actor",)), ("splunk", (), (" api",)), ("tor", ("tor inc1",), ()))
_CAT = f"""{with_tables('tagrows')}, n AS (SELECT DISTINCT trim(name) AS name FROM tagrows),
 c AS (SELECT name, CASE WHEN lower(name) = 'view splunk api' OR contains(lower(name), 'error') THEN 'agency' WHEN contains(lower(name), 'actor') THEN 'actors' WHEN contains(lower(name), ' api') THEN 'splunk'
   WHEN lower(name) = 'tor inc1' THEN 'tor' ELSE 'other' END AS category FROM n)"""


@register("categorize_tags", f"{_CAT} SELECT name, category FROM c")
def _(spark, sf):
    from .data import tag_rows

    return feeds.categorize_tags(tag_rows(spark, sf), _RULES, "name")


@register("categorize_tags_members", f"""{_CAT} SELECT name, CASE WHEN name = 'actor 3' THEN 'listed' WHEN name = 'click Splunk API' THEN 'other list' ELSE category END AS category FROM c""")
def _(spark, sf):
    from .data import tag_rows

    listed = (("listed", ("actor 3", "ACTOR 4")), ("other list", (" click Splunk API ", "actor 3")))
    return feeds.categorize_tags(tag_rows(spark, sf), _RULES, "name", listed)


@register("tags_per_category", f"{_CAT} SELECT category, count(*) AS n FROM c GROUP BY 1")
def _(spark, sf):
    from .data import tag_rows

    return feeds.tags_per_category(feeds.categorize_tags(tag_rows(spark, sf), _RULES, "name"))


_MOD = "0::HUGEINT"
for _k in range(64):
    _MOD = f"(({_MOD}) * 16 + (position(substr(h, {_k + 1}, 1) IN '0123456789abcdef') - 1)) % 97"


@register("stable_bucket", f"SELECT c_custkey, c_name, CAST({_MOD} AS BIGINT) AS bucket FROM (SELECT c_custkey, c_name, sha256(c_name) AS h FROM customer)")
def _(spark, sf):
    return feeds.stable_bucket(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name", 97)


@register("attribute_flatten", f"""{with_tables('recs', 'tagrows')}, one AS (SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY id) = 1)
  SELECT one.indicator, one.id, arg_min(t.name, (pos, part, supp)) AS attr_name, arg_min(t.part, (pos, part, supp)) AS attr_id FROM one LEFT JOIN tagrows t ON one.id = t.id GROUP BY ALL""")
def _(spark, sf):
    df = records(spark, sf).withColumn("attributes", F.transform("tags", lambda t: F.struct(t["id"].alias("id"), t["name"].alias("name"))))
    return feeds.attribute_flatten(df, "id").select("indicator", "id", "attr_name", "attr_id")


@register("author_filter", f"""{with_tables('recs', 'tagrows')}, one AS (SELECT * FROM recs WHERE description = 'F' AND ownerName = '1-URGENT' QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY id) = 1)
  SELECT one.indicator, one.id, {joined('t.group_name', ', ')} AS group_names FROM one LEFT JOIN tagrows t ON one.id = t.id GROUP BY ALL""")
def _(spark, sf):
    df = records(spark, sf).withColumns({"author_first": F.col("description"), "author_last": F.col("ownerName")})
    return feeds.author_filter(df, "F", "1-URGENT", "id").select("indicator", "id", "group_names")


@register("master_listing_upsert", f"""WITH x AS (SELECT o_custkey % 50 AS partner, o_orderpriority AS report, o_custkey AS indicator, CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE ' ' END AS benign, CASE WHEN o_orderstatus <> 'O' THEN 'x' ELSE '' END AS blocked, o_orderstatus FROM orders),
  m AS (SELECT DISTINCT partner, report, indicator FROM x WHERE o_orderstatus = 'O'),
  n AS (SELECT partner, report, indicator, min(CASE WHEN benign = 'x' THEN 1 WHEN blocked = 'x' THEN 2 END) AS c FROM x GROUP BY ALL)
  SELECT partner, report, indicator, CAST(NULL AS BIGINT) AS disposition_code, NULL::VARCHAR AS disposition FROM m
  UNION ALL SELECT partner, report, indicator, {i('c')}, CASE c WHEN 1 THEN 'benign' WHEN 2 THEN 'blocked' END FROM n WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.partner = n.partner AND m.report = n.report AND m.indicator = n.indicator)""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 50).alias("partner"), F.col("o_orderpriority").alias("report"), F.col("o_custkey").alias("indicator"),
        F.when(F.col("o_orderstatus") == "F", "x").otherwise(" ").alias("benign"),
        F.when(F.col("o_orderstatus") != "O", "x").otherwise("").alias("blocked"), "o_orderstatus",
    )
    master = rows.where("o_orderstatus = 'O'").select("partner", "report", "indicator").distinct()
    return tidy(feeds.master_listing_upsert(master, rows, ("benign", "blocked")), "partner", "report", "indicator", "disposition_code", "disposition")
