"""Queries of the join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import joins
from .data import AS_OF, observations, record_rows, records, score_rows, table, tag_rows, text, with_tables
from .registry import register
from .tidy import d, i, r, tidy

OBS, RECS, SCORES = with_tables("obs"), with_tables("recs"), with_tables("scores")


@register("attach_context", f"""{with_tables('recs', 'scores')}, c AS (SELECT indicator, count(*) AS n_records, max(confidence) AS top FROM recs GROUP BY 1)
  SELECT s.indicator, {i('s.score')} AS score, coalesce(n_records, 0) AS n_records, {r('coalesce(top, 0)')} AS top FROM scores s LEFT JOIN c ON s.indicator = c.indicator""")
def _(spark, sf):
    dim = record_rows(spark, sf).groupBy("indicator").agg(
        F.count("*").alias("n_records"), F.max("confidence").alias("top")
    )
    out = joins.attach_context(score_rows(spark, sf).select("indicator", "score"), dim, fill={"n_records": 0, "top": 0.0})
    return tidy(out)


for _name, _fn in (("lookup_first", "arg_min"), ("lookup_last", "arg_max")):
    def _query(spark, sf, name=_name):
        tags = tag_rows(spark, sf).join(record_rows(spark, sf).select("id", "indicator"), "id").select(
            "id", "pos", "part", "supp", "indicator", fx.agency_partner(F.col("name")).alias("OpDiv")
        )
        obs = observations(spark, sf).groupBy("indicator", "OpDiv", "obs_date").agg(F.sum("observations").alias("o"))
        fn = getattr(joins, name)
        return tidy(fn(tags, obs.select("indicator", "OpDiv", "obs_date"), ("indicator", "OpDiv"), "obs_date", ("obs_date",)))

    _agg = "min" if _name == "lookup_first" else "max"
    register(_name, f"""{with_tables('obs', 'recs', 'tagrows')}, o AS (SELECT indicator, OpDiv, {_agg}(obs_date) AS obs_date FROM obs GROUP BY ALL)
      SELECT t.id, t.pos, t.part, t.supp, r.indicator, regexp_replace(t.name, '\\s+Splunk API$', '') AS OpDiv, {d('o.obs_date')} AS obs_date
      FROM tagrows t JOIN recs r ON t.id = r.id LEFT JOIN o ON o.indicator = r.indicator AND o.OpDiv = regexp_replace(t.name, '\\s+Splunk API$', '')""")(_query)


@register("tag_observation_join", f"""{with_tables('obs', 'recs', 'tagrows')}, t AS (SELECT DISTINCT r.indicator, regexp_replace(t.name, '\\s+Splunk API$', '') AS OpDiv FROM tagrows t JOIN recs r ON t.id = r.id)
  SELECT DISTINCT t.indicator, t.OpDiv, {d('o.obs_date')} AS obs_date FROM t JOIN obs o ON t.indicator = o.indicator AND t.OpDiv = o.OpDiv""")
def _(spark, sf):
    tags = tag_rows(spark, sf).join(record_rows(spark, sf).select("id", "indicator"), "id").select(
        "indicator", fx.agency_partner(F.col("name")).alias("OpDiv")
    ).distinct()
    return tidy(joins.tag_observation_join(tags, observations(spark, sf)))


def _listed(spark, sf):
    return table(spark, sf, "supplier").select(text("s_suppkey").alias("indicator"))


for _name, _not in (("keep_listed", ""), ("drop_reported", "NOT")):
    def _query(spark, sf, name=_name):
        rows = observations(spark, sf).select("indicator", "OpDiv", "observations")
        return getattr(joins, name)(rows, _listed(spark, sf))

    register(_name, f"""{OBS} SELECT indicator, OpDiv, observations FROM obs WHERE indicator {_not} IN
      (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""")(_query)


@register("full_outer_sources", """WITH l AS (SELECT CAST(l_partkey AS VARCHAR) AS k, string_agg(DISTINCT 'vt/' || CAST(l_suppkey AS VARCHAR), ', ' ORDER BY 'vt/' || CAST(l_suppkey AS VARCHAR)) AS s FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
  o AS (SELECT CAST(l_partkey AS VARCHAR) AS k, string_agg(DISTINCT 'otx/' || CAST(l_suppkey AS VARCHAR), ', ' ORDER BY 'otx/' || CAST(l_suppkey AS VARCHAR)) AS s FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
  SELECT coalesce(l.k, o.k) AS search_term, concat_ws(', ', l.s, o.s) AS sources FROM l FULL JOIN o ON l.k = o.k""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")

    def feed(flag, prefix):
        return lines.where(F.col("l_returnflag") == flag).select(
            text("l_partkey").alias("search_term"), F.concat(F.lit(prefix), text("l_suppkey")).alias("link")
        )

    return joins.full_outer_sources(feed("A", "vt/"), feed("R", "otx/")).drop("part")


@register("tags_groups_outer", f"""{with_tables('recs', 'tagrows')} SELECT r.indicator, r.id, t.name AS tag_name, g.group_id, g.group_type, g.group_name
  FROM recs r LEFT JOIN tagrows t ON r.id = t.id LEFT JOIN tagrows g ON r.id = g.id""")
def _(spark, sf):
    return joins.tags_groups_outer(records(spark, sf))


@register("partner_buckets", f"{SCORES} SELECT indicator, unnest(partners) AS partner FROM scores")
def _(spark, sf):
    return joins.partner_buckets(score_rows(spark, sf)).select("indicator", "partner")


@register("recency_range_join", f"""{SCORES}, a AS (SELECT indicator, last_observed, DATE '2024-01-30' - last_observed AS age FROM scores)
  SELECT indicator, {d('last_observed')} AS last_observed, p AS period FROM a JOIN (VALUES ('0-7 Days', 7, -1), ('8-14 Days', 14, 7), ('15-21 Days', 21, 14), ('22-30 Days', 30, 21)) AS v(p, a, b)
  ON age <= v.a AND age > v.b""")
def _(spark, sf):
    out = joins.recency_range_join(score_rows(spark, sf), AS_OF, "last_observed")
    return tidy(out, "indicator", "last_observed", "period")


# whole benchmark passages, and their last two words as short phrases
@register("keyphrase_join", """WITH p AS (SELECT item_id, text AS phrase FROM benchmark
   UNION ALL SELECT item_id, upper(regexp_extract(text, '[^ ]+ [^ ]+$')) FROM benchmark)
  SELECT doc_id, item_id, phrase FROM documents JOIN p ON contains(lower(text), lower(phrase))""")
def _(spark, sf):
    bench = table(spark, sf, "benchmark")
    phrases = bench.select("item_id", F.col("text").alias("phrase")).unionByName(
        bench.select("item_id", F.upper(F.regexp_extract("text", "[^ ]+ [^ ]+$", 0)).alias("phrase"))
    )
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return joins.keyphrase_join(docs, phrases).select("doc_id", "item_id", "phrase")


@register("compare_snapshots", f"""WITH t AS (SELECT l_shipmonth, sum(q) FILTER (WHERE y = 1999) AS a, sum(q) FILTER (WHERE y = 2000) AS b FROM
   (SELECT month(l_shipdate) AS l_shipmonth, year(l_shipdate) AS y, l_quantity AS q FROM lineitem) GROUP BY 1)
  SELECT {i('l_shipmonth')} AS horizon, {r('a')} AS previous, {r('b')} AS current, {r('(b - a) / nullif(a, 0) * 100')} AS percent_change FROM t""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.month("l_shipdate").alias("horizon"), F.year("l_shipdate").alias("y"), "l_quantity"
    )

    def year(y):
        return lines.where(F.col("y") == y).groupBy("horizon").agg(F.sum("l_quantity").alias("total"))

    return tidy(joins.compare_snapshots(year(1999), year(2000), "horizon", "total"))


@register("backfill_zero_scores", f"""{with_tables('scores', 'recs')}, f AS (SELECT indicator, max(observations) AS fresh FROM recs WHERE observations <> 0 GROUP BY 1)
  SELECT s.indicator, CASE WHEN coalesce(s.score, 0) = 0 AND fresh IS NOT NULL THEN fresh ELSE s.score END::BIGINT AS score FROM scores s LEFT JOIN f ON s.indicator = f.indicator""")
def _(spark, sf):
    fresh = record_rows(spark, sf).select("indicator", F.col("observations").alias("score"))
    return tidy(joins.backfill_zero_scores(score_rows(spark, sf), fresh), "indicator", "score")


@register("exclude_by_attribute_author", f"""{SCORES}, a AS (SELECT CAST(o_custkey AS VARCHAR) AS indicator, o_orderstatus AS author FROM orders WHERE o_orderpriority = '1-URGENT')
  SELECT indicator, {i('score')} AS score FROM scores s WHERE EXISTS (SELECT 1 FROM a WHERE a.indicator = s.indicator AND author <> 'F')
  OR NOT EXISTS (SELECT 1 FROM a WHERE a.indicator = s.indicator)""")
def _(spark, sf):
    attributes = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        text("o_custkey").alias("indicator"), F.col("o_orderstatus").alias("author")
    )
    out = joins.exclude_by_attribute_author(score_rows(spark, sf), attributes, "F")
    return tidy(out, "indicator", "score")


@register("diff_lists", """SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1)""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    return joins.diff_lists(lines.where("l_returnflag = 'A'"), lines.where("l_linenumber = 1"), "l_partkey")
