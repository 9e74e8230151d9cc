"""Structured Streaming jobs over the batch operators.

Every job takes a streaming DataFrame, a checkpoint folder and a sink folder, processes what is
available and stops; run it again to continue where it stopped.  Watermarks bound the state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.feeds import triage_infrastructure
from ..sources.ingest import clean_observations

DELAY = "2 days"


def read_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
    files_per_batch: int | None = None, glob: str | None = None,
) -> DataFrame:
    """File source with an explicit schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def _append(df: DataFrame, checkpoint: str, sink: str) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).option("path", sink).trigger(availableNow=True).start()


def stream_observations(source: DataFrame, checkpoint: str, sink: str, delay: str = DELAY) -> StreamingQuery:
    """Clean sightings, one row per indicator, partner and day within the watermark."""
    rows = clean_observations(source).withColumn("obs_ts", F.col("obs_date").cast("timestamp"))
    unique = rows.withWatermark("obs_ts", delay).dropDuplicatesWithinWatermark(["indicator", "OpDiv", "obs_date"])
    return _append(unique, checkpoint, sink)


def daily_partner_counts(df: DataFrame) -> DataFrame:
    """Sightings per partner and day; works on batch and streaming input with ``ts``."""
    return df.groupBy("OpDiv", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n")).select(
        "OpDiv", F.col("w.start").alias("day"), "n"
    )


def stream_daily_counts(
    source: DataFrame, checkpoint: str, sink: str, delay: str = DELAY, emit: str = "closed"
) -> StreamingQuery:
    """Daily counts.

    ``emit="closed"`` writes a day once the watermark has passed it.  ``emit="all"`` writes every count
    that a batch changed, those of open days too, for ``read_windows`` to take the newest of each.
    """
    counts = daily_partner_counts(source.withWatermark("ts", delay))
    return _append(counts, checkpoint, sink) if emit == "closed" else _update(counts, checkpoint, sink)


def daily_partials(df: DataFrame) -> DataFrame:
    """Observations and partners per indicator and day, of which any number of days can be put together."""
    return df.groupBy("indicator", F.window("ts", "1 day").alias("w")).agg(
        F.sum("observations").alias("total_obs"), F.collect_set("OpDiv").alias("partners")
    ).select("indicator", F.col("w.start").alias("day"), "total_obs", "partners")


def _flagged(weeks: DataFrame, min_total: int, min_partners: int) -> DataFrame:
    flag = (F.col("total_obs") >= min_total) & (F.col("partners") >= min_partners)
    return weeks.select("indicator", "start", "total_obs", "partners", flag.alias("mass_scanner"))


def weekly_totals(df: DataFrame, min_total: int = 1_000_000, min_partners: int = 5) -> DataFrame:
    """Seven-day totals per indicator, sliding by a day.

    Partners are counted as the size of their set, which is exact and, with few partners, small.
    """
    out = df.groupBy("indicator", F.window("ts", "7 days", "1 day").alias("w")).agg(
        F.sum("observations").alias("total_obs"),
        F.size(F.collect_set("OpDiv")).cast("long").alias("partners"),
    )
    return _flagged(out.withColumn("start", F.col("w.start")), min_total, min_partners)


def weeks_of_days(days: DataFrame, min_total: int = 1_000_000, min_partners: int = 5) -> DataFrame:
    """``weekly_totals`` from one row per indicator and day: a week is put together from seven days."""
    starts = F.sequence(F.col("day") - F.expr("INTERVAL 6 DAYS"), F.col("day"), F.expr("INTERVAL 1 DAY"))
    out = days.withColumn("start", F.explode(starts)).groupBy("indicator", "start").agg(
        F.sum("total_obs").alias("total_obs"),
        F.size(F.array_distinct(F.flatten(F.collect_list("partners")))).cast("long").alias("partners"),
    )
    return _flagged(out, min_total, min_partners)


def stream_mass_scanner(
    source: DataFrame, checkpoint: str, sink: str, delay: str = DELAY, emit: str = "closed", **limits: int
) -> StreamingQuery:
    """Sliding weeks per indicator.

    ``emit="closed"`` writes a week once the watermark has passed it.  ``emit="all"`` keeps one state
    row per indicator and day and writes the days that a batch changed; ``read_weeks`` puts the weeks,
    open ones too, together.
    """
    marked = source.withWatermark("ts", delay)
    if emit == "closed":
        return _append(weekly_totals(marked, **limits), checkpoint, sink)
    return _update(daily_partials(marked), checkpoint, sink)


def sighting_sessions(df: DataFrame, gap: str = "1 day") -> DataFrame:
    """Runs of sightings of an indicator without a pause longer than ``gap``."""
    return df.groupBy("indicator", F.session_window("ts", gap).alias("s")).agg(
        F.count("*").alias("n"), F.sum("observations").alias("total_obs")
    ).select("indicator", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n", "total_obs")


def merge_sessions(parts: DataFrame) -> DataFrame:
    """Sessions from pieces of them: pieces that overlap are one session.

    An end lies one gap after the last sighting, so two pieces belong together where one begins
    before the other's end.
    """
    order = W.partitionBy("indicator").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opened = F.when(F.col("start") < reached, 0).otherwise(1)
    rows = parts.withColumn("_new", opened).withColumn("_session", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy("indicator", "_session").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), F.sum("total_obs").alias("total_obs")
    ).drop("_session")


def stream_sessions(
    source: DataFrame, checkpoint: str, sink: str, delay: str = DELAY, gap: str = "1 day", emit: str = "closed"
) -> StreamingQuery:
    """Sessions of sightings.

    ``emit="closed"`` writes a session once the watermark has passed its end.  ``emit="all"`` needs no
    state at all: every batch writes the pieces of sessions that its own rows form, and
    ``read_sessions`` merges pieces that belong together, late ones and open ones too.
    """
    if emit == "closed":
        return _append(sighting_sessions(source.withWatermark("ts", delay), gap), checkpoint, sink)
    return _each_batch(source, checkpoint, lambda batch, batch_id: _put(sighting_sessions(batch, gap), sink, batch_id))


def read_windows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each window of a stream that writes what its batches changed."""
    newest = W.partitionBy(*keys).orderBy(F.col("part").desc())
    rows = spark.read.parquet(path).withColumn("_rn", F.row_number().over(newest))
    return rows.where("_rn = 1").drop("_rn", "part")


def read_weeks(spark: SparkSession, path: str, **limits: int) -> DataFrame:
    return weeks_of_days(read_windows(spark, path, ("indicator", "day")), **limits)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    return merge_sessions(spark.read.parquet(path).drop("part"))


# ------------------------------------------------------------------- tables grown by batches


def _each_batch(source: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> StreamingQuery:
    writer = source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def start_table(df: DataFrame, path: str) -> None:
    """First part of a table that batches will add to."""
    df.write.mode("errorifexists").parquet(f"{path}/part=0")


def _update(df: DataFrame, checkpoint: str, sink: str) -> StreamingQuery:
    """Rows that a batch changed go to the batch's own folder."""
    writer = df.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: _put(batch, sink, batch_id))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch owns its folder, so a repeated batch replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path}/part={batch_id + 1}")


def read_scores(spark: SparkSession, path: str, key: str = "indicator") -> DataFrame:
    """Current score table: the newest part's row per key."""
    newest = W.partitionBy(key).orderBy(F.col("part").desc())
    rows = spark.read.parquet(path).withColumn("_rn", F.row_number().over(newest))
    return rows.where("_rn = 1").drop("_rn", "part")


def read_history(spark: SparkSession, path: str, key: str = "indicator", ts: str = "scoring_date") -> DataFrame:
    """Score history: the last row per key and day, a later part winning ties."""
    last = W.partitionBy(key, F.to_date(ts)).orderBy(F.col(ts).desc(), F.col("part").desc())
    rows = spark.read.parquet(path).withColumn("_rn", F.row_number().over(last))
    return rows.where("_rn = 1").drop("_rn", "part")


def compact(df: DataFrame, path: str) -> None:
    """Write a merged table as the first part of a fresh folder."""
    start_table(df, path)


def stream_upsert_scores(
    source: DataFrame, checkpoint: str, scores: str, history: str, key: str = "indicator",
    ts: str = "scoring_date",
) -> StreamingQuery:
    """Upsert every batch into the score table and append it to the history.

    A batch writes only its own rows, whatever the size of the tables; ``read_scores`` and
    ``read_history`` merge the parts, and ``compact`` folds them from time to time.
    """
    last = W.partitionBy(key).orderBy(F.col(ts).desc())

    def update(batch: DataFrame, batch_id: int) -> None:
        newest = batch.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", ts)
        _put(newest, scores, batch_id)
        _put(batch, history, batch_id)

    return _each_batch(source, checkpoint, update)


def stream_resume_triage(source: DataFrame, checkpoint: str, sink: str) -> StreamingQuery:
    """Triage new indicators batch by batch, starting after the last finished batch."""

    def triage(batch: DataFrame, batch_id: int) -> None:
        _put(triage_infrastructure(batch), sink, batch_id)

    return _each_batch(source, checkpoint, triage)
