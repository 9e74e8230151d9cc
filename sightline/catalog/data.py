"""The supplied tables read as the domain tables, once in Spark and once as SQL text.

The SQL fragments are common-table expressions; ``with_tables('obs', …)`` strings them together
for a query's SQL twin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-30"  # last day of the events table
PARTNERS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sighting: events read as partner observations."""
    return table(spark, sf_dir, "events").select(
        text("user_id").alias("indicator"),
        F.lpad(text(F.col("event_id") % 3), 20, "0").alias("API_UserName"),
        F.to_date("ts").alias("obs_date"),
        F.col("event_type").alias("OpDiv"),
        F.ceil("value").cast("long").alias("observations"),
    )


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


TYPES = ("Address", "Host", "URL", "EmailAddress", "File")
GROUP_TYPES = ("Adversary", "Incident", "Report")


def tag_name() -> Column:
    part = F.col("l_partkey")
    return (
        F.when(part % 11 == 0, F.lit("I&W"))
        .when(part % 7 == 0, F.concat(F.lit("actor "), text(part % 10)))
        .when(part % 13 == 0, F.concat(F.lit("TOR INC"), text(part % 5)))
        .otherwise(F.concat(_pick(F.col("l_suppkey"), PARTNERS), F.lit(" Splunk API")))
    )


def tag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").cast("long").alias("pos"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        tag_name().alias("name"),
        F.when(F.col("l_linenumber") == 1, F.lpad(text("l_suppkey"), 16, "6755399444000000"))
        .otherwise(text("l_suppkey")).alias("group_id"),
        _pick(F.col("l_partkey"), GROUP_TYPES).alias("group_type"),
        F.concat(F.lit("G"), text(F.col("l_partkey") % 20)).alias("group_name"),
    )


def record_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat part of the indicator records: one per order."""
    key = F.col("o_orderkey")
    seen = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((key % 30).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.concat(text("o_custkey"), F.lit(" : extra")).alias("summary"),
        text("o_custkey").alias("indicator"),
        _pick(F.col("o_custkey"), TYPES).alias("type"),
        F.col("o_orderpriority").alias("ownerName"),
        (seen - F.make_dt_interval((key % 400).cast("int"))).alias("dateAdded"),
        (seen - F.make_dt_interval((key % 5).cast("int"))).alias("lastModified"),
        seen.alias("lastObserved"),
        F.when(key % 9 != 0, (key % 6).cast("double")).alias("rating"),
        F.when(key % 10 != 0, (key % 101).cast("double")).alias("confidence"),
        F.floor(F.col("o_totalprice") / 10).cast("long").alias("observations"),
        (key % 3).alias("falsePositives"),
        (key * 7 % 1000).cast("double").alias("calScore"),
        (key * 3 % 1000).cast("double").alias("threatAssessScore"),
        F.col("o_orderstatus").alias("description"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested indicator records: order columns plus tag and group arrays from its lines.

    An order has few lines, so the per-order lists are short.
    """
    rows = tag_rows(spark, sf_dir)
    nested = rows.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "part", "supp", "name"))).alias("_t"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    "pos", "part", "supp",
                    F.struct(
                        F.col("group_id").alias("id"), F.col("group_type").alias("type"),
                        F.col("group_name").alias("name"), F.lit("org").alias("ownerName"),
                    ).alias("g"),
                )
            )
        ).alias("_g"),
    )
    nested = nested.select(
        "id",
        F.transform(
            "_t",
            lambda t: F.struct(
                t["part"].alias("id"), t["name"].alias("name"),
                F.lit(None).cast("timestamp").alias("lastUsed"),
                F.lit(None).cast("string").alias("description"),
            ),
        ).alias("tags"),
        F.transform("_g", lambda g: g["g"]).alias("associatedGroups"),
        F.transform(
            "_g",
            lambda g: F.struct(
                F.when(g["pos"] % 2 == 0, "VirusTotal").otherwise("Shodan").alias("type"),
                F.when(g["pos"] % 2 == 0, g["part"] % 40).alias("vtMaliciousCount"),
                F.array(F.concat(F.lower(g["g"]["name"]), F.lit(".example"))).alias("domains"),
                F.array(g["g"]["type"]).alias("tags"),
                F.when(g["pos"] % 2 == 1, F.concat(F.lit("C"), text(g["supp"] % 9))).alias("country"),
            ),
        ).alias("enrichment"),
    )
    return record_rows(spark, sf_dir).join(nested, "id", "left")


def tag_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag categories per indicator: several rows per customer, with blanks."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        text("o_custkey").alias("indicator"),
        F.col("o_orderpriority").alias("tag"),
        F.col("o_orderstatus").alias("threat_category"),
        F.when(key % 3 == 0, F.concat(F.lit("NS"), text(key % 7))).alias("nation_state"),
        F.when(key % 5 == 0, F.concat(F.lit("CVE-"), text(key % 40))).alias("cve_nbr"),
    )


def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score row per customer, with an integer score from 0 to 1000."""
    key = F.col("c_custkey")
    score = F.least(F.lit(1000), F.greatest(F.lit(0), F.floor(F.col("c_acctbal") / 10))).cast("int")
    return table(spark, sf_dir, "customer").select(
        text(key).alias("indicator"),
        F.col("c_mktsegment").alias("actor"),
        _pick(key, TYPES).alias("indicator_type"),
        score.alias("score"),
        (key % 997).cast("int").alias("old_score"),
        F.when(key % 4 != 0, (key % 60)).alias("vt_count"),
        (F.col("c_nationkey") * 4).cast("double").alias("confidence"),
        (key % 6).cast("double").alias("rating"),
        F.array_compact(
            F.array(*[F.when(F.shiftright(key, i) % 2 == 1, F.lit(p)) for i, p in enumerate(PARTNERS)])
        ).alias("partners"),
        F.date_sub(F.lit(AS_OF).cast("date"), (key % 120).cast("int")).alias("last_observed"),
        F.lit("VT score: ").alias("_vt"),
    ).withColumn("explanation", F.concat("_vt", text("vt_count"), F.lit("."))).drop("_vt")


def score_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring inputs: one row per customer, with gaps, caps and flags of every kind."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    sources = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.array_sort(F.collect_set("o_orderpriority")).alias("sources")
    )

    def cases(mod: int, values: list[str]) -> Column:
        out = F.array().cast("array<string>")
        for rest, value in enumerate(values):
            out = F.when(key % mod == rest, F.array(F.lit(value))).otherwise(out)
        return out

    rows = table(spark, sf_dir, "customer").join(sources, key == F.col("o_custkey"), "left")
    return rows.select(
        text(key).alias("indicator"),
        _pick(key, TYPES).alias("indicator_type"),
        F.date_sub(F.lit(AS_OF).cast("date"), (key % 120).cast("int")).alias("last_observed"),
        F.array_compact(
            F.array(*[F.when(F.shiftright(key, i) % 2 == 1, F.lit(p)) for i, p in enumerate(PARTNERS)])
        ).alias("partners"),
        "sources",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("Actor "), text(key % 10))).alias("threat_actor"),
        F.when(key % 6 == 0, F.concat(F.lit("Incident:INC"), text(key))).when(key % 6 == 1, "None").alias("incident"),
        F.when(key % 4 != 0, key % 60).alias("vt_count"),
        (key % 400).alias("obs_days"),
        F.when(key % 9 != 0, (key % 8).cast("double")).alias("rating"),
        F.when(key % 10 != 0, (key % 130).cast("double")).alias("confidence"),
        (balance * 0.1234567).alias("cal_score"),
        (balance * 0.0987653).alias("external_score"),
        (key % 3).alias("false_positives"),
        cases(7, ["tor", "monitor", "masscan"]).alias("tag_names"),
        cases(11, ["TOR activity", "Web Scanner"]).alias("enrich_tags"),
        cases(13, ["DDoS"]).alias("botnet_tags"),
        F.when(key % 3 != 0, F.date_sub(F.lit(AS_OF).cast("date"), (key % 40).cast("int"))).alias("firstseen_date"),
        (key % 17 == 0).alias("mass_scanner"),
    )


# ---------------------------------------------------------------------------------------------
# The same tables as SQL
# ---------------------------------------------------------------------------------------------

_PARTNER_LIST = "['click','error','purchase','signup','view']"
_TYPE_LIST = "['Address','Host','URL','EmailAddress','File']"

CTES = {
    "obs": """obs AS (SELECT CAST(user_id AS VARCHAR) AS indicator,
        lpad(CAST(event_id % 3 AS VARCHAR), 20, '0') AS API_UserName, CAST(ts AS DATE) AS obs_date,
        event_type AS OpDiv, CAST(ceil(value) AS BIGINT) AS observations FROM events)""",
    "tagrows": f"""tagrows AS (SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS pos,
        l_partkey AS part, l_suppkey AS supp,
        CASE WHEN l_partkey % 11 = 0 THEN 'I&W'
             WHEN l_partkey % 7 = 0 THEN 'actor ' || CAST(l_partkey % 10 AS VARCHAR)
             WHEN l_partkey % 13 = 0 THEN 'TOR INC' || CAST(l_partkey % 5 AS VARCHAR)
             ELSE {_PARTNER_LIST}[l_suppkey % 5 + 1] || ' Splunk API' END AS name,
        CASE WHEN l_linenumber = 1 THEN lpad(CAST(l_suppkey AS VARCHAR), 16, '6755399444000000')
             ELSE CAST(l_suppkey AS VARCHAR) END AS group_id,
        ['Adversary','Incident','Report'][l_partkey % 3 + 1] AS group_type,
        'G' || CAST(l_partkey % 20 AS VARCHAR) AS group_name FROM lineitem)""",
    "recs": f"""recs AS (SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS indicator,
        {_TYPE_LIST}[o_custkey % 5 + 1] AS type, o_orderpriority AS ownerName,
        TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INT))
          - to_days(CAST(o_orderkey % 400 AS INT)) AS dateAdded,
        TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INT))
          - to_days(CAST(o_orderkey % 5 AS INT)) AS lastModified,
        TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INT)) AS lastObserved,
        CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 6 AS DOUBLE) END AS rating,
        CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey % 101 AS DOUBLE) END AS confidence,
        CAST(floor(o_totalprice / 10) AS BIGINT) AS observations, o_orderkey % 3 AS falsePositives,
        CAST(o_orderkey * 7 % 1000 AS DOUBLE) AS cal, CAST(o_orderkey * 3 % 1000 AS DOUBLE) AS ext, o_orderstatus AS description FROM orders)""",
    "dim": """dim AS (SELECT CAST(o_custkey AS VARCHAR) AS indicator, o_orderpriority AS tag,
        o_orderstatus AS threat_category,
        CASE WHEN o_orderkey % 3 = 0 THEN 'NS' || CAST(o_orderkey % 7 AS VARCHAR) END AS nation_state,
        CASE WHEN o_orderkey % 5 = 0 THEN 'CVE-' || CAST(o_orderkey % 40 AS VARCHAR) END AS cve_nbr
        FROM orders)""",
    "scores": f"""scores AS (SELECT CAST(c_custkey AS VARCHAR) AS indicator, c_mktsegment AS actor,
        {_TYPE_LIST}[c_custkey % 5 + 1] AS indicator_type,
        CAST(least(1000, greatest(0, floor(c_acctbal / 10))) AS INT) AS score,
        CAST(c_custkey % 997 AS INT) AS old_score,
        CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 60 END AS vt_count,
        CAST(c_nationkey * 4 AS DOUBLE) AS confidence, CAST(c_custkey % 6 AS DOUBLE) AS rating,
        list_filter({_PARTNER_LIST}, lambda p: (c_custkey >> (list_position({_PARTNER_LIST}, p) - 1)) % 2 = 1)
          AS partners,
        DATE '2024-01-30' - CAST(c_custkey % 120 AS INT) AS last_observed,
        'VT score: ' || CAST(CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 60 END AS VARCHAR) || '.'
          AS explanation FROM customer)""",
    "inputs": f"""inputs AS (SELECT CAST(c_custkey AS VARCHAR) AS indicator, {_TYPE_LIST}[c_custkey % 5 + 1] AS indicator_type,
        DATE '2024-01-30' - CAST(c_custkey % 120 AS INT) AS last_observed, bit_count(CAST(c_custkey & 31 AS INT)) AS pn,
        coalesce(s.n, 0) AS sn, s.s AS sources, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Actor ' || CAST(c_custkey % 10 AS VARCHAR) END AS actor,
        CASE WHEN c_custkey % 6 = 0 THEN 'Incident:INC' || CAST(c_custkey AS VARCHAR) END AS incident,
        CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 60 END AS vt_count, c_custkey % 400 AS obs_days,
        CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 8 AS DOUBLE) END AS rating,
        CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey % 130 AS DOUBLE) END AS confidence,
        c_acctbal * 0.1234567 AS cal_score, c_acctbal * 0.0987653 AS external_score, c_custkey % 3 AS fp,
        c_custkey % 7 = 0 OR c_custkey % 11 = 0 AS tor_word, c_custkey % 7 IN (0, 1) OR c_custkey % 11 = 0 AS tor_sub,
        c_custkey % 7 = 2 OR c_custkey % 11 = 1 AS scanner, c_custkey % 13 = 0 AS botnet, c_custkey % 17 = 0 AS mass,
        CASE WHEN c_custkey % 3 <> 0 THEN DATE '2024-01-30' - CAST(c_custkey % 40 AS INT) END AS first_seen
        FROM customer LEFT JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n,
          string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS s FROM orders GROUP BY 1) s ON c_custkey = s.o_custkey)""",
    # dense per-(partner, indicator) daily panel of indicators seen on at least two days
    "panel": """days AS (SELECT OpDiv, indicator, obs_date AS date, sum(observations) AS observations
          FROM obs GROUP BY ALL),
        span AS (SELECT OpDiv, min(date) AS first_day FROM days GROUP BY OpDiv),
        repeat_keys AS (SELECT OpDiv, indicator, count(*) AS total_seen FROM days
          WHERE observations > 0 GROUP BY ALL HAVING count(*) >= 2),
        grid AS (SELECT k.OpDiv, k.indicator, k.total_seen,
            CAST(unnest(generate_series(s.first_day, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date
          FROM repeat_keys k JOIN span s ON k.OpDiv = s.OpDiv),
        panel AS (SELECT g.OpDiv, g.indicator, g.date, CAST(coalesce(d.observations, 0) AS BIGINT) AS observations,
            CAST(isodow(g.date) - 1 AS INT) AS dayofweek, isodow(g.date) >= 6 AS is_weekend,
            CAST(day(g.date) AS INT) AS day, CAST(month(g.date) AS INT) AS month,
            CASE WHEN coalesce(d.observations, 0) > 0 THEN 1 ELSE 0 END AS seen,
            CAST(g.total_seen AS BIGINT) AS total_seen
          FROM grid g LEFT JOIN days d ON g.OpDiv = d.OpDiv AND g.indicator = d.indicator AND g.date = d.date)""",
}
_NEEDS = {"panel": ("obs",)}


def with_tables(*names: str) -> str:
    """``WITH …`` prefix defining the named tables."""
    wanted: list[str] = []
    for name in names:
        for need in (*_NEEDS.get(name, ()), name):
            if need not in wanted:
                wanted.append(need)
    return "WITH " + ",\n".join(CTES[n] for n in wanted)
