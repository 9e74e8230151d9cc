"""Queries of the streaming jobs: each runs until all input is processed, then reads the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import streams as st
from .data import observations, score_rows, table, text, with_tables
from .q_feeds import _NET, _network
from .registry import register
from .tidy import d, i, tidy

def _run(query):
    query.awaitTermination()


def _sightings(spark, sf):
    """The events table as a stream of sightings."""
    schema = table(spark, sf, "events").schema
    rows = st.read_stream(spark, sf, schema, glob="events.parquet")
    return rows.select(
        text("user_id").alias("indicator"), F.col("event_type").alias("OpDiv"), F.col("ts").cast("timestamp").alias("ts"),
        F.ceil("value").cast("long").alias("observations"),
    )


def _sink(spark, job, source, **options) -> str:
    checkpoint, sink = scratch_path(spark, "stream-state"), scratch_path(spark, "stream-out")
    _run(job(source, checkpoint, sink, **options))
    return sink


@register("stream_observations", f"{with_tables('obs')} SELECT DISTINCT indicator, OpDiv, {d('obs_date')} AS obs_date FROM obs")
def _(spark, sf):
    path = scratch_path(spark, "stream-in")
    raw = observations(spark, sf).withColumn("indicator", F.concat("indicator", F.lit(" note")))
    raw.write.parquet(path)
    sink = _sink(spark, st.stream_observations, st.read_stream(spark, path, raw.schema))
    return tidy(spark.read.parquet(sink), "indicator", "OpDiv", "obs_date")


@register("stream_daily_counts", f"""SELECT event_type AS OpDiv, {d('ts')} AS day, count(*) AS n FROM events GROUP BY ALL""")
def _(spark, sf):
    sink = _sink(spark, st.stream_daily_counts, _sightings(spark, sf), emit="all")
    return tidy(st.read_windows(spark, sink, ("OpDiv", "day")))


@register("stream_mass_scanner", f"""WITH w AS (SELECT CAST(unnest(generate_series(DATE '2023-12-26', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS start)
  SELECT CAST(user_id AS VARCHAR) AS indicator, {d('start')} AS start, {i('sum(ceil(value))')} AS total_obs, count(DISTINCT event_type) AS partners,
  sum(ceil(value)) >= 1200 AND count(DISTINCT event_type) >= 5 AS mass_scanner FROM events JOIN w ON ts >= start AND ts < start + 7 GROUP BY ALL""")
def _(spark, sf):
    sink = _sink(spark, st.stream_mass_scanner, _sightings(spark, sf), emit="all")
    return tidy(st.read_weeks(spark, sink, min_total=1200, min_partners=5))


@register("stream_sessions", f"""WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 1 DAY THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
  SELECT CAST(user_id AS VARCHAR) AS indicator, CAST(min(ts) AS VARCHAR) AS start, CAST(max(ts) + INTERVAL 1 DAY AS VARCHAR) AS "end", count(*) AS n, {i('sum(ceil(value))')} AS total_obs
  FROM s GROUP BY user_id, s""")
def _(spark, sf):
    out = st.read_sessions(spark, _sink(spark, st.stream_sessions, _sightings(spark, sf), emit="all"))
    return out.withColumns({"start": F.col("start").cast("string"), "end": F.col("end").cast("string")})


@register("stream_upsert_scores", f"""{with_tables('scores')} SELECT indicator, {i("CASE WHEN actor = 'BUILDING' THEN old_score ELSE score END")} AS score, CASE WHEN actor = 'MACHINERY' THEN 1 ELSE 2 END::BIGINT AS n_history FROM scores
  WHERE actor <> 'BUILDING' UNION ALL SELECT indicator, {i('old_score')}, 1 FROM scores WHERE actor = 'BUILDING'""")
def _(spark, sf):
    base, news, scores, history = (scratch_path(spark, n) for n in ("state", "in", "scores", "history"))
    rows = score_rows(spark, sf)
    old = rows.where("actor <> 'MACHINERY'")
    st.start_table(old.select("indicator", F.col("old_score").alias("score")), scores)
    day = F.lit("2024-01-01").cast("timestamp")
    st.start_table(old.select("indicator", F.col("old_score").alias("score"), day.alias("scoring_date")), history)
    new = rows.where("actor <> 'BUILDING'").select("indicator", "score", F.lit("2024-01-02").cast("timestamp").alias("scoring_date"))
    new.repartition(3, "indicator").write.parquet(news)
    _run(st.stream_upsert_scores(st.read_stream(spark, news, new.schema, files_per_batch=1), base, scores, history))
    counts = st.read_history(spark, history).groupBy("indicator").agg(F.count("*").alias("n_history"))
    return tidy(st.read_scores(spark, scores).join(counts, "indicator"), "indicator", "score", "n_history")


@register("stream_resume_triage", f"{_NET} SELECT * FROM tri")
def _(spark, sf):
    base, source, sink = (scratch_path(spark, n) for n in ("state", "in", "triage"))
    rows = _network(spark, sf)
    rows.repartition(4, "indicator").write.parquet(source)
    _run(st.stream_resume_triage(st.read_stream(spark, source, rows.schema, files_per_batch=1), base, sink))
    return spark.read.parquet(sink).select("indicator", "behavior", "flags", "recommendation")
