"""Queries of the readers, writers and table maintenance.

Files to read are first written by Spark from the supplied tables.
"""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import struct, DOUBLE, LONG, STRING
from ..session import scratch_path
from ..sources import buckets as bk
from ..sources import ingest
from .data import observations, record_rows, score_rows, table, text, with_tables
from .registry import register
from .tidy import d, i, r, tidy

OBS, SCORES = with_tables("obs"), with_tables("scores")


def _raw(spark, sf):
    """Sightings as a partner delivers them: trailing text, padding and audit columns."""
    return observations(spark, sf).select(
        F.concat("indicator", F.lit(" : note")).alias("indicator"), "API_UserName",
        F.col("obs_date").cast("string").alias("obs_date"), F.concat(F.lit(" "), "OpDiv", F.lit(" ")).alias("OpDiv"),
        F.concat_ws("_", "indicator", "OpDiv").alias("indicator_key"), "observations",
        F.col("obs_date").cast("string").alias("curr_date"),
    )


def _day_files(spark, sf):
    path = scratch_path(spark, "days")
    name = F.concat(F.lit("obs_d"), F.replace("obs_date", F.lit("-"), F.lit("")), F.lit(".csv"))
    rows = _raw(spark, sf).withColumn("file", name)
    # quoting keeps the padding that the reader must cope with
    rows.repartition("file").write.partitionBy("file").option("header", True).option("quoteAll", True).csv(path)
    return path


@register("scan_daily_files", f"""{OBS} SELECT indicator || ' : note' AS indicator, "API_UserName", {d('obs_date')} AS obs_date, OpDiv, observations, {d('obs_date')} AS file_date
  FROM obs WHERE obs_date BETWEEN DATE '2024-01-20' AND DATE '2024-01-30'""")
def _(spark, sf):
    # two days past the data are missing and skipped
    rows = ingest.scan_daily_files(spark, _day_files(spark, sf), "2024-01-20", "2024-02-01")
    return tidy(rows.withColumn("OpDiv", F.trim("OpDiv")), "indicator", "API_UserName", "obs_date", "OpDiv", "observations", "file_date")


@register("clean_observations", f"""{OBS} SELECT indicator, "API_UserName", {d('obs_date')} AS obs_date, OpDiv, observations FROM obs WHERE "API_UserName" <> '00000000000000000002'""")
def _(spark, sf):
    return tidy(ingest.clean_observations(_raw(spark, sf), ("00000000000000000002",)))


_REPORT = struct(Indicator=STRING, Seen=LONG)


@register("scan_report_tree", f"""{OBS} SELECT indicator AS "Indicator", observations AS "Seen", OpDiv AS "Partner", {d('obs_date')} AS "FileDate" FROM obs WHERE OpDiv <> 'error'""")
def _(spark, sf):
    path = scratch_path(spark, "reports")
    day = F.date_format("obs_date", "yyyyMMdd")
    rows = observations(spark, sf).select(
        F.col("indicator").alias("Indicator"), F.col("observations").alias("Seen"), F.col("OpDiv").alias("Partner"),
        F.concat(F.lit("report_"), day, F.lit(".csv")).alias("file"),
    )
    rows.repartition("file").write.partitionBy("Partner", "file").option("header", True).csv(path)
    return tidy(ingest.scan_report_tree(spark, path, exclude=("Partner=error",), schema=_REPORT))


@register("scan_report_tree_day", f"""{OBS} SELECT indicator AS "Indicator", observations AS "Seen", OpDiv AS "Partner", {d('obs_date')} AS "FileDate" FROM obs WHERE obs_date = DATE '2024-01-11'""")
def _(spark, sf):
    path = scratch_path(spark, "reports")
    day = F.date_format("obs_date", "yyyyMMdd")
    rows = observations(spark, sf).select(
        F.col("indicator").alias("Indicator"), F.col("observations").alias("Seen"), F.col("OpDiv").alias("Partner"),
        F.concat(F.lit("report_"), day, F.lit(".csv")).alias("file"),
    )
    rows.repartition("file").write.partitionBy("Partner", "file").option("header", True).csv(path)
    return tidy(ingest.scan_report_tree(spark, path, "2024-01-11", schema=_REPORT))


_JSON = struct(key=LONG, total=DOUBLE, owner=struct(id=LONG, status=STRING))


def _nested(spark, sf):
    path = scratch_path(spark, "json")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("owner"),
    )
    ingest.write_table(rows, path, "json")
    return ingest.read_json_records(spark, path, _JSON)


@register("read_json_records", "SELECT o_orderkey AS key, o_totalprice AS total, o_custkey AS owner_id, o_orderstatus AS status FROM orders")
def _(spark, sf):
    return _nested(spark, sf).select("key", "total", F.col("owner.id").alias("owner_id"), "owner.status")


@register("flatten_record", """SELECT o_orderkey AS key, o_totalprice AS total, o_custkey AS "owner.id", o_orderstatus AS "owner.status" FROM orders""")
def _(spark, sf):
    return ingest.flatten_record(_nested(spark, sf))


@register("merge_incremental", f"""{OBS}, a AS (SELECT * FROM obs WHERE obs_date <= DATE '2024-01-20'), b AS (SELECT DISTINCT ON (indicator, OpDiv, obs_date) indicator, OpDiv, obs_date FROM obs WHERE obs_date > DATE '2024-01-20')
  SELECT indicator, OpDiv, {d('obs_date')} AS obs_date, n FROM (SELECT indicator, OpDiv, obs_date, count(*) AS n FROM a GROUP BY ALL UNION ALL SELECT *, 1 FROM b)""")
def _(spark, sf):
    obs = observations(spark, sf)
    old, new = obs.where("obs_date <= '2024-01-20'"), obs.where("obs_date >= '2024-01-15'")
    out = ingest.merge_incremental(old, new, "obs_date", ("indicator", "OpDiv", "obs_date"))
    return tidy(out.groupBy("indicator", "OpDiv", "obs_date").agg(F.count("*").alias("n")))


@register("split_by_partner", f"{OBS} SELECT DISTINCT indicator, OpDiv, {d('obs_date')} AS obs_date, observations FROM obs")
def _(spark, sf):
    path = scratch_path(spark, "partners")
    obs = observations(spark, sf).drop("API_UserName")
    ingest.split_by_partner(obs.where("obs_date <= '2024-01-20'"), obs.where("obs_date >= '2024-01-15'"), "OpDiv", path)
    return tidy(spark.read.parquet(path), "indicator", "OpDiv", "obs_date", "observations")


for _fmt in ("csv", "json", "parquet"):
    def _query(spark, sf, fmt=_fmt):
        path = scratch_path(spark, "table")
        rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
        ingest.write_table(rows, path, fmt)
        ingest.write_table(rows.limit(1), path, fmt, "ignore")  # the existing table stays
        reader = spark.read.schema(rows.schema)
        return (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)

    register("write_table" if _fmt == "parquet" else f"write_table_{_fmt}", "SELECT c_custkey, c_name, c_mktsegment FROM customer")(_query)


@register("validate_columns", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, sf):
    return ingest.validate_columns(table(spark, sf, "supplier"), ("s_suppkey", "s_name")).select("s_suppkey", "s_name")


@register("table_profile", """SELECT count(*) AS rows, CAST(6 AS BIGINT) AS columns, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS names FROM orders""")
def _(spark, sf):
    return tidy(ingest.table_profile(table(spark, sf, "orders")))


_OLD_NEW = f"""{SCORES}, o AS (SELECT indicator, CASE WHEN actor = 'FURNITURE' THEN score ELSE old_score END AS score, actor FROM scores WHERE actor <> 'MACHINERY'),
  n AS (SELECT indicator, score, actor FROM scores WHERE actor <> 'BUILDING')"""


@register("upsert_table", f"""{_OLD_NEW} SELECT coalesce(n.indicator, o.indicator) AS indicator, {i('CASE WHEN n.indicator IS NOT NULL THEN n.score ELSE o.score END')} AS score, coalesce(n.actor, o.actor) AS actor,
  CASE WHEN o.indicator IS NULL THEN 'added' WHEN n.indicator IS NULL THEN 'preserved' WHEN o.score = n.score THEN 'unchanged' ELSE 'updated' END AS change FROM o FULL JOIN n ON o.indicator = n.indicator""")
def _(spark, sf):
    scores = score_rows(spark, sf)
    before = F.when(F.col("actor") == "FURNITURE", F.col("score")).otherwise(F.col("old_score"))
    old = scores.where("actor <> 'MACHINERY'").select("indicator", before.alias("score"), "actor")
    new = scores.where("actor <> 'BUILDING'").select("indicator", "score", "actor", F.lit(2).alias("run"))
    repeated = new.unionByName(new.withColumns({"run": F.lit(1), "score": F.col("score") + 1}))
    return tidy(ingest.upsert_table(old, repeated, "indicator", ("run",)))


@register("upsert_bucketed", f"""{_OLD_NEW} SELECT coalesce(n.indicator, o.indicator) AS indicator, {i('CASE WHEN n.indicator IS NOT NULL THEN n.score ELSE o.score END')} AS score, coalesce(n.actor, o.actor) AS actor FROM o FULL JOIN n ON o.indicator = n.indicator""")
def _(spark, sf):
    """The upsert in two batches into a table of hash buckets."""
    scores, path = score_rows(spark, sf), scratch_path(spark, "bucketed")
    before = F.when(F.col("actor") == "FURNITURE", F.col("score")).otherwise(F.col("old_score"))
    old = scores.where("actor <> 'MACHINERY'").select("indicator", before.alias("score"), "actor")
    new = scores.where("actor <> 'BUILDING'").select("indicator", "score", "actor", F.lit(2).alias("run"))
    repeated = new.unionByName(new.withColumns({"run": F.lit(1), "score": F.col("score") + 1}))
    bk.create_table(old, path, "indicator", 16)
    for version, half in enumerate((F.col("actor") < "G", F.col("actor") >= "G"), 1):
        bk.upsert_bucketed(spark, path, repeated.where(half), "indicator", version, ("run",))
    return tidy(bk.read_table(spark, path, old.schema))


_HISTORY = f"""{OBS}, h AS (SELECT indicator, ts, run, v FROM (SELECT CAST(user_id AS VARCHAR) AS indicator, date_trunc('minute', ts) AS ts, 0 AS run, max(CAST(ceil(value) AS BIGINT)) AS v FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL
    UNION ALL SELECT CAST(user_id AS VARCHAR), date_trunc('minute', ts), 1, max(CAST(ceil(value) AS BIGINT)) FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY ALL))
  SELECT indicator, CAST(ts AS VARCHAR) AS scoring_date, v FROM h QUALIFY row_number() OVER (PARTITION BY indicator, CAST(ts AS DATE) ORDER BY ts DESC, run DESC) = 1"""


def _score_runs(spark, sf):
    rows = table(spark, sf, "events").select(
        text("user_id").alias("indicator"), F.date_trunc("minute", "ts").cast("timestamp").alias("scoring_date"),
        F.ceil("value").cast("long").alias("v"), F.when(F.col("event_type").isin("click", "view"), 0).otherwise(1).alias("run"),
    )
    runs = rows.groupBy("indicator", "scoring_date", "run").agg(F.max("v").alias("v"))
    return [runs.where(F.col("run") == k).drop("run") for k in (0, 1)]


@register("append_history", _HISTORY)
def _(spark, sf):
    old, new = _score_runs(spark, sf)
    out = ingest.append_history(old, new, "indicator", "scoring_date")
    return out.withColumn("scoring_date", F.date_format("scoring_date", "yyyy-MM-dd HH:mm:ss"))


@register("append_bucketed", _HISTORY)
def _(spark, sf):
    """The history in three batches into buckets within days."""
    (old, new), path = _score_runs(spark, sf), scratch_path(spark, "bucketed")
    begun, later = old.where("scoring_date < '2024-01-11'"), old.where("scoring_date >= '2024-01-11'")
    last = W.partitionBy("indicator", F.to_date("scoring_date")).orderBy(F.col("scoring_date").desc())
    bk.create_table(begun.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n"), path, "indicator", 4, ts="scoring_date")
    for version, batch in enumerate((later, new), 1):
        bk.append_bucketed(spark, path, batch, "indicator", "scoring_date", version)
    out = bk.read_table(spark, path, old.schema)
    return out.withColumn("scoring_date", F.date_format("scoring_date", "yyyy-MM-dd HH:mm:ss"))


@register("group_documents", """SELECT DISTINCT o_custkey, o_orderstatus || ':' || o_orderpriority AS record FROM orders""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    grouped = ingest.group_documents(rows.where("o_orderstatus <> 'F'"), rows.where("o_orderstatus <> 'O'"), "o_custkey")
    shown = F.transform("records", lambda x: F.concat_ws(":", x["o_orderstatus"], x["o_orderpriority"]))
    return grouped.select("o_custkey", F.explode(shown).alias("record"))


def _library(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("ingest_order"),
        F.when(key % 3 == 0, "preferred-source").otherwise("search").alias("kind"),
        F.concat(F.lit("t"), text(F.col("o_custkey") % 40)).alias("term"),
        F.when(key % 4 != 0, F.concat(F.lit("u"), text(key % 5))).alias("url_normalized"),
        F.concat(F.lit("u"), text(key % 5)).alias("url"), F.col("o_orderpriority").alias("source"),
        F.date_format("o_orderdate", "yyyy-MM").alias("saved_at"),
    )


@register("dedupe_library", f"""WITH l AS (SELECT o_orderkey AS ingest_order, CASE WHEN o_orderkey % 3 = 0 THEN 'preferred-source' ELSE 'search' END AS kind, 't' || CAST(o_custkey % 40 AS VARCHAR) AS term,
   'u' || CAST(o_orderkey % 5 AS VARCHAR) AS url, o_orderpriority AS source, strftime(o_orderdate, '%Y-%m') AS saved_at FROM orders)
  SELECT ingest_order, kind, term, url, source, saved_at FROM l QUALIFY row_number() OVER (PARTITION BY kind, term, url, CASE WHEN kind = 'search' THEN '' ELSE source END ORDER BY saved_at DESC, ingest_order DESC) = 1""")
def _(spark, sf):
    return ingest.dedupe_library(_library(spark, sf)).select("ingest_order", "kind", "term", "url", "source", "saved_at")


# within the batch every title is unique here, so SQL can follow the rule; see the tests for chains
@register("skip_known_articles", """WITH s AS (SELECT DISTINCT text AS title, 'u' || CAST(doc_id % 700 AS VARCHAR) AS url FROM documents WHERE lang = 'en'),
  n AS (SELECT doc_id AS ingest_order, CAST(doc_id AS VARCHAR) || text AS title, 'u' || CAST(doc_id % 900 AS VARCHAR) AS url FROM documents WHERE lang <> 'en'),
  k AS (SELECT * FROM n WHERE url NOT IN (SELECT url FROM s) AND title NOT IN (SELECT title FROM s) QUALIFY row_number() OVER (PARTITION BY url ORDER BY ingest_order) = 1)
  SELECT ingest_order, url, (SELECT count(*) FROM s) + row_number() OVER (ORDER BY ingest_order) - 1 AS text_id FROM k""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    key = F.col("doc_id")
    stored = docs.where("lang = 'en'").select(F.col("text").alias("title"), F.concat(F.lit("u"), text(key % 700)).alias("url")).distinct()
    new = docs.where("lang <> 'en'").select(
        key.alias("ingest_order"), F.concat(text(key), F.col("text")).alias("title"), F.concat(F.lit("u"), text(key % 900)).alias("url")
    )
    return ingest.skip_known_articles(stored, new).select("ingest_order", "url", "text_id")
