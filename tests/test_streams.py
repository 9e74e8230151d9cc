"""Streams equal their batch operators and resume where they stopped."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sightline.sources.ingest import append_history, upsert_table
from sightline.streaming import streams as st

SCHEMA = "indicator string, OpDiv string, ts timestamp, observations long"


@pytest.fixture()
def sightings(spark, tmp_path):
    """Three files of sightings in time order, and the same rows as a batch."""
    start = datetime(2024, 1, 1)
    rows = [
        (f"i{n % 5}", "PQ"[n % 2], start + timedelta(hours=7 * n + (40 if n > 30 and n % 5 == 1 else 0)), n + 1)
        for n in range(120)
    ]
    for part in range(3):
        spark.createDataFrame(rows[part * 40 : part * 40 + 40], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    batch = spark.createDataFrame(rows, SCHEMA)
    return str(tmp_path / "in"), batch, tmp_path


def closed(df, end, batch):
    mark = batch.agg(F.max("ts") - F.expr("interval 2 days")).first()[0]
    return df.where(F.expr(end) <= F.lit(mark))


@pytest.mark.parametrize("job, operator, end", [
    (st.stream_daily_counts, st.daily_partner_counts, "day + interval 1 day"),
    (st.stream_mass_scanner, st.weekly_totals, "start + interval 7 days"),
    (st.stream_sessions, st.sighting_sessions, "`end`"),
])
def test_windows_equal_batch(spark, rows, sightings, job, operator, end):
    path, batch, tmp = sightings
    source = st.read_stream(spark, path, batch.schema, files_per_batch=1)
    job(source, str(tmp / "state"), str(tmp / "out")).awaitTermination()
    got = rows(spark.read.parquet(str(tmp / "out")))
    assert got and got == rows(closed(operator(batch), end, batch))


def test_observations_dedupe_and_resume(spark, rows, tmp_path):
    schema = "indicator string, API_UserName string, obs_date string, OpDiv string, observations long"

    def drop(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        source = st.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        st.stream_observations(source, str(tmp_path / "state"), str(tmp_path / "out")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")), "indicator", "OpDiv", F.col("obs_date").cast("string"))

    drop("a", [("x note", "1", "2024-01-01", " VA", 3), ("x", "1", "2024-01-01", "VA", 3)])
    assert run() == [("x", "VA", "2024-01-01")]
    drop("b", [("x", "1", "2024-01-01", "VA", 3), ("x", "1", "2024-01-02", "VA", 4)])
    assert run() == [("x", "VA", "2024-01-01"), ("x", "VA", "2024-01-02")]


def test_upsert_stream_equals_batch_upserts(spark, rows, tmp_path):
    day = lambda d, h=0: datetime(2024, 1, d, h)
    cols = "indicator string, score int, scoring_date timestamp"
    first = spark.createDataFrame([("a", 1, day(1)), ("b", 2, day(1))], cols)
    batches = [
        spark.createDataFrame([("b", 3, day(2)), ("c", 4, day(2)), ("c", 5, day(2, 6))], cols),
        spark.createDataFrame([("a", 9, day(3)), ("b", 3, day(2))], cols),
    ]
    scores, history = str(tmp_path / "scores"), str(tmp_path / "history")
    st.start_table(first.drop("scoring_date"), scores)
    st.start_table(first, history)
    table, log = first.drop("scoring_date"), first
    for n, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = st.read_stream(spark, str(tmp_path / "in"), first.schema)
        st.stream_upsert_scores(source, str(tmp_path / "state"), scores, history).awaitTermination()
        table = upsert_table(table, batch, "indicator", ("scoring_date",)).drop("change")
        log = append_history(log, batch, "indicator", "scoring_date")
    assert rows(st.read_scores(spark, scores), "indicator", "score") == rows(table, "indicator", "score")
    assert rows(st.read_history(spark, history), "indicator", "score") == rows(log, "indicator", "score")
    st.compact(st.read_scores(spark, scores), str(tmp_path / "compact"))
    assert rows(st.read_scores(spark, str(tmp_path / "compact"))) == rows(table)


@pytest.mark.parametrize("job, operator, read", [
    (st.stream_daily_counts, st.daily_partner_counts, lambda spark, path: st.read_windows(spark, path, ("OpDiv", "day"))),
    (st.stream_mass_scanner, st.weekly_totals, st.read_weeks),
    (st.stream_sessions, st.sighting_sessions, st.read_sessions),
])
def test_open_windows_equal_batch(spark, rows, sightings, job, operator, read):
    path, batch, tmp = sightings
    source = st.read_stream(spark, path, batch.schema, files_per_batch=1)
    job(source, str(tmp / "state"), str(tmp / "out"), emit="all").awaitTermination()
    want = operator(batch)
    assert rows(read(spark, str(tmp / "out")), *want.columns) == rows(want)


def test_pieces_of_sessions_out_of_order(spark, rows):
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    data = [("a", "P", at(h), 1) for h in (0, 20, 50, 73, 74, 200)] + [("b", "P", at(h), 2) for h in (0, 24, 25)]
    whole = spark.createDataFrame(data, SCHEMA)
    pieces = [whole.where(F.hour("ts") % 3 == k) for k in range(3)]
    parts = st.sighting_sessions(pieces[2]).unionByName(st.sighting_sessions(pieces[0])).unionByName(st.sighting_sessions(pieces[1]))
    want = st.sighting_sessions(whole)
    assert rows(st.merge_sessions(parts), *want.columns) == rows(want)
