"""Queries of the clean-up operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from .data import record_rows, records, score_rows, table, text, with_tables
from .registry import register
from .tidy import d, i, r, tidy

RECS, SCORES = with_tables("recs"), with_tables("scores")


@register("drop_missing", f"{RECS} SELECT id, {r('rating')} AS rating, {r('confidence')} AS confidence FROM recs WHERE rating IS NOT NULL AND confidence IS NOT NULL")
def _(spark, sf):
    return tidy(clean.drop_missing(record_rows(spark, sf).select("id", "rating", "confidence")))


@register("fill_missing", f"{RECS} SELECT id, {r('coalesce(rating, -1)')} AS rating, {r('coalesce(confidence, -1)')} AS confidence FROM recs")
def _(spark, sf):
    return tidy(clean.fill_missing(record_rows(spark, sf).select("id", "rating", "confidence"), -1.0))


@register("dedupe_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _(spark, sf):
    return clean.dedupe_rows(table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority"))


@register("dedupe_rows_keep_last", f"""SELECT o_custkey, o_orderkey, {d('o_orderdate')} AS o_orderdate FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def _(spark, sf):
    out = clean.dedupe_rows(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "last")
    return tidy(out, "o_custkey", "o_orderkey", "o_orderdate")


@register("outlier_threshold", "SELECT event_id, value FROM events WHERE value < 50")
def _(spark, sf):
    return clean.outlier_threshold(table(spark, sf, "events").select("event_id", "value"), "value", 50)


@register("outlier_iqr", f"""WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
  SELECT event_id, value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS is_outlier FROM events, q""")
def _(spark, sf):
    return clean.outlier_iqr(table(spark, sf, "events"), "value").select("event_id", "is_outlier")


@register("drop_columns", "SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size FROM part")
def _(spark, sf):
    return tidy(clean.drop_columns(table(spark, sf, "part"), ["p_type", "p_retailprice"]))


@register("extract_numeric", "SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS p_brand FROM part")
def _(spark, sf):
    return clean.extract_numeric(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand")


def _dates(spark, sf):
    """Order dates as text, every seventh one spoilt."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(key % 7 == 0, F.concat(F.lit("bad "), day)).otherwise(day).alias("day")
    )


_DATES = """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'bad ' ELSE '' END ||
  strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"""


@register("cast_datetime", f"{_DATES} SELECT o_orderkey, {d('TRY_CAST(day AS TIMESTAMP)')} AS day FROM t")
def _(spark, sf):
    return tidy(clean.cast_datetime(_dates(spark, sf), "day"))


@register("date_or_na", f"{_DATES} SELECT o_orderkey, coalesce(strftime(TRY_CAST(day AS TIMESTAMP), '%Y-%m-%d'), 'N/A') AS day FROM t")
def _(spark, sf):
    return clean.date_or_na(_dates(spark, sf), "day")


def _numbers(spark, sf):
    """Item numbers as text: a plain number, a percentage, or words."""
    value = F.format_string("%.2f", F.col("l_discount") * 100)
    key = F.col("l_partkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(key % 5 == 0, F.lit("x")).when(key % 5 == 1, F.lit("")).when(key % 5 == 2, value)
        .otherwise(F.concat(value, F.lit("%"))).alias("v"),
    )


_NUMBERS = """WITH t AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN ''
  WHEN 2 THEN printf('%.2f', l_discount * 100) ELSE printf('%.2f', l_discount * 100) || '%' END AS v FROM lineitem)"""


@register("cast_numeric", f"{_NUMBERS} SELECT * REPLACE ({r('TRY_CAST(v AS DOUBLE)')} AS v) FROM t")
def _(spark, sf):
    return tidy(clean.cast_numeric(_numbers(spark, sf), "v"))


@register("parse_percent", f"{_NUMBERS} SELECT * REPLACE ({r('''TRY_CAST(rtrim(v, '%') AS DOUBLE)''')} AS v) FROM t")
def _(spark, sf):
    return tidy(clean.parse_percent(_numbers(spark, sf), "v"))


@register("format_percent", """SELECT c_custkey, CAST(CAST(round_even(least(greatest(c_acctbal / 8000 * 100, 0.0), 100.0) * 100, 0) / 100 AS DOUBLE) AS VARCHAR) || '%' AS share FROM customer""")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 8000).alias("share"))
    return clean.format_percent(df, "share")


@register("cast_string", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part")
def _(spark, sf):
    return clean.cast_string(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size")


@register("cast_category", """SELECT p_partkey, p_type, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LARGE' THEN 2 END::BIGINT AS p_type_code FROM part""")
def _(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_type")
    return tidy(clean.cast_category(df, "p_type", ("SMALL", "MEDIUM", "LARGE")))


for _name in ("lower", "upper", "strip"):
    def _query(spark, sf, name=_name):
        df = table(spark, sf, "documents").select(
            "doc_id", F.concat(F.lit("  "), F.col("source"), F.lit(" Ab "), F.col("lang"), F.lit(" ")).alias("v")
        )
        return getattr(clean, name)(df, "v")

    _fn = {"lower": "lower", "upper": "upper", "strip": "trim"}[_name]
    register(_name, f"SELECT doc_id, {_fn}('  ' || source || ' Ab ' || lang || ' ') AS v FROM documents")(_query)


@register("split_column", """SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS colour,
  CASE WHEN contains(p_name, ' ') THEN split_part(p_name, ' ', 2) END AS thing FROM part""")
def _(spark, sf):
    return clean.split_column(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", " ", ("colour", "thing"))


@register("canonical_agency_tag", f"""{with_tables('tagrows')}, t AS (SELECT id, pos, part, supp, replace(CASE WHEN supp % 5 = 0 THEN 'VA CSOC CTS Splunk' ELSE name END, 'VA CSOC CTS Splunk', 'VA Splunk API') AS name FROM tagrows)
  SELECT id, pos, part, supp, name, regexp_replace(name, '\\s+Splunk API$', '') AS partner FROM t""")
def _(spark, sf):
    from .data import tag_rows

    df = tag_rows(spark, sf).select("id", "pos", "part", "supp", F.when(F.col("supp") % 5 == 0, "VA CSOC CTS Splunk").otherwise(F.col("name")).alias("name"))
    return clean.canonical_agency_tag(df, "name")


@register("normalize_group_id", f"""{with_tables('tagrows')} SELECT id, pos, part, supp, CASE WHEN regexp_full_match(group_id, '\\d{{16}}') THEN group_id END AS group_id FROM tagrows""")
def _(spark, sf):
    from .data import tag_rows

    padded = F.when(F.col("part") % 6 == 0, " None ").otherwise(F.col("group_id"))
    df = tag_rows(spark, sf).select("id", "pos", "part", "supp", "group_id")
    spoilt = df.where(F.col("pos") > 1).withColumn("group_id", padded).unionByName(df.where(F.col("pos") <= 1))
    return clean.normalize_group_id(spoilt, "group_id")


@register("first_group_id", f"""{with_tables('recs', 'tagrows')}, g AS (SELECT id, arg_min(group_id, (pos, part, supp)) FILTER (WHERE length(group_id) = 16) AS group_id FROM tagrows GROUP BY id)
 SELECT recs.id, g.group_id FROM recs LEFT JOIN g ON recs.id = g.id""")
def _(spark, sf):
    return clean.first_group_id(records(spark, sf)).select("id", "group_id")


_ADDR = """WITH t AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  CASE l_partkey % 4 WHEN 0 THEN CAST(l_partkey % 300 AS VARCHAR) || '.' || CAST(l_suppkey % 300 AS VARCHAR) || '.' || CAST(l_orderkey % 256 AS VARCHAR) || '.7'
   WHEN 1 THEN 'host' || CAST(l_suppkey AS VARCHAR) || '.example.org' WHEN 2 THEN 'localname' ELSE '2001:db8::' || CAST(l_linenumber AS VARCHAR) END AS v FROM lineitem)"""


def _addresses(spark, sf):
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey", "l_suppkey",
        F.when(part % 4 == 0, F.concat_ws(".", text(part % 300), text(supp % 300), text(F.col("l_orderkey") % 256), F.lit("7")))
        .when(part % 4 == 1, F.concat(F.lit("host"), text(supp), F.lit(".example.org")))
        .when(part % 4 == 2, "localname").otherwise(F.concat(F.lit("2001:db8::"), text("l_linenumber"))).alias("v"),
    )


_V4 = "regexp_full_match(v, '((25[0-5]|2[0-4]\\d|1\\d\\d|0?\\d?\\d)\\.){3}(25[0-5]|2[0-4]\\d|1\\d\\d|0?\\d?\\d)')"


@register("classify_query_type", f"""{_ADDR} SELECT *, CASE WHEN {_V4} OR v LIKE '2001:%' THEN 'ip' WHEN contains(v, '.') THEN 'hostname' ELSE 'domain' END AS query_type FROM t""")
def _(spark, sf):
    return clean.classify_query_type(_addresses(spark, sf), "v")


@register("is_ipv4", f"{_ADDR} SELECT *, {_V4} AS is_ipv4 FROM t")
def _(spark, sf):
    return clean.is_ipv4(_addresses(spark, sf), "v")


@register("coalesce_columns", f"{RECS} SELECT id, {r('coalesce(rating, confidence)')} AS v FROM recs")
def _(spark, sf):
    return tidy(clean.coalesce_columns(record_rows(spark, sf), "v", ["assessed", "rating", "confidence"]), "id", "v")


@register("extract_incident_ids", f"""{with_tables('tagrows')},
  g AS (SELECT id, string_agg('Incident:' || group_id, ';' ORDER BY pos, part, supp) FILTER (WHERE group_type = 'Incident') AS g FROM tagrows GROUP BY id),
  t AS (SELECT o_orderkey AS id, 'see inc' || CAST(o_orderkey % 50 AS VARCHAR) || ' and INC' || CAST(o_custkey % 3 AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN ' inc' || CAST(o_orderkey % 50 AS VARCHAR) ELSE '' END AS txt FROM orders)
  SELECT t.id, concat_ws(';', g.g, 'Incident:INC' || CAST(t.id % 50 AS VARCHAR), CASE WHEN t.id % 50 <> o.o_custkey % 3 THEN 'Incident:INC' || CAST(o.o_custkey % 3 AS VARCHAR) END) AS incident_label
  FROM t JOIN orders o ON o.o_orderkey = t.id LEFT JOIN g ON t.id = g.id""")
def _(spark, sf):
    key = F.col("id")
    named = F.concat(
        F.lit("see inc"), text(key % 50), F.lit(" and INC"), text(F.col("indicator").cast("long") % 3),
        F.when(key % 2 == 0, F.concat(F.lit(" inc"), text(key % 50))).otherwise(""),
    )
    return clean.extract_incident_ids(records(spark, sf).withColumn("description", named)).select("id", "incident_label")


@register("extract_vt_score", f"{SCORES} SELECT indicator, explanation, TRY_CAST(regexp_extract(explanation, 'VT score:\\s*(\\d+)', 1) AS BIGINT) AS vt_score FROM scores")
def _(spark, sf):
    return clean.extract_vt_score(score_rows(spark, sf)).select("indicator", "explanation", "vt_score")


@register("report_indicator_from_name", """SELECT DISTINCT CASE WHEN s_suppkey % 2 = 0 THEN 'h' || CAST(s_suppkey % 40 AS VARCHAR) || '.example.com' ELSE '10.1.0.' || CAST(s_suppkey % 40 AS VARCHAR) END AS indicator FROM supplier WHERE s_nationkey <> 3""")
def _(spark, sf):
    key = F.col("s_suppkey")
    part = F.when(F.col("s_nationkey") == 3, F.lit("Summary")).when(
        key % 2 == 0, F.concat(F.lit("I&W_Report_h"), text(key % 40), F.lit(".example.com"))
    ).otherwise(F.concat(F.lit("I&W_Report_10.1.0."), text(key % 40)))
    names = table(spark, sf, "supplier").select(F.concat(part, F.lit(".docx")).alias("file"))
    return clean.report_indicator_from_name(names, "file")


_SEV = "CASE WHEN score < 200 THEN 'low' WHEN score < 500 THEN 'medium' WHEN score < 800 THEN 'high' WHEN score < 1001 THEN 'critical' END"


@register("bucket_scores", f"""{SCORES} SELECT indicator, {_SEV} AS severity,
  CASE WHEN score <= 0 THEN NULL WHEN score <= 200 THEN 'low' WHEN score <= 500 THEN 'medium' WHEN score <= 800 THEN 'high' ELSE 'critical' END AS severity_right FROM scores""")
def _(spark, sf):
    out = clean.bucket_scores(score_rows(spark, sf), "score")
    out = clean.bucket_scores(out, "score", closed="right", out="severity_right")
    return out.select("indicator", "severity", "severity_right")


@register("bucket_counts", f"""{SCORES} SELECT indicator, CASE WHEN n IS NULL THEN 'Unknown' WHEN n = 0 THEN '0' WHEN n <= 5 THEN '1-5' WHEN n <= 10 THEN '6-10' WHEN n <= 25 THEN '11-25'
  WHEN n <= 50 THEN '26-50' WHEN n <= 100 THEN '51-100' ELSE '100+' END AS count_bucket FROM (SELECT indicator, vt_count * 3 AS n FROM scores)""")
def _(spark, sf):
    df = score_rows(spark, sf).withColumn("n", F.col("vt_count") * 3)
    return clean.bucket_counts(df, "n").select("indicator", "count_bucket")


@register("bucket_threat_band", f"{SCORES} SELECT indicator, CASE WHEN score >= 700 THEN 'Critical' WHEN score >= 400 THEN 'High' WHEN score >= 100 THEN 'Medium' ELSE 'Low' END AS threat_band FROM scores")
def _(spark, sf):
    return clean.bucket_threat_band(score_rows(spark, sf), "score").select("indicator", "threat_band")
