"""Keyed tables in hash buckets: a batch rewrites only the buckets that its keys fall into.

A table is a folder.  ``data/version=N/bucket=B`` holds the whole content of bucket B as batch N left
it, and ``manifest/version=N`` names the buckets that batch N wrote; a bucket's current content is
that of the greatest version that names it.  A batch writes its data first and its manifest, one small
file, last.  So readers see a batch wholly or not at all, the files of other buckets stay as they
are, and a batch that is run again after a failure replaces what it left, or does nothing if it had
been finished.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin
from .ingest import upsert_table

BUCKETS = 256


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("string")


def _day_bucket(key: str, ts: str, buckets: int) -> Column:
    day = F.coalesce(F.date_format(F.to_date(ts), "yyyy-MM-dd"), F.lit("none"))
    return F.concat_ws("_", day, _bucket(key, buckets))


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("bucket string, buckets int, version int").parquet(f"{path}/manifest")


def _write(spark: SparkSession, rows: DataFrame, path: str, version: int, buckets: int, touched: DataFrame | None = None) -> None:
    data = f"{path}/data/version={version}"
    rows.write.mode("overwrite").partitionBy("bucket").parquet(data)
    named = (spark.read.schema("bucket string").parquet(data) if touched is None else touched).select("bucket").distinct()
    named.select("bucket", F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")


def create_table(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, ts: str | None = None) -> None:
    """Write ``df`` as version 0.  With ``ts`` the table is a history, whose buckets lie within days."""
    place = _day_bucket(key, ts, buckets) if ts else _bucket(key, buckets)
    rows = df.withColumn("bucket", place)
    _write(df.sparkSession, rows.repartition("bucket"), path, 0, buckets)


def current_buckets(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, version): where the current content of each bucket lies."""
    return _manifest(spark, path).groupBy("bucket").agg(F.max("version").alias("version"))


def _read(spark: SparkSession, path: str, schema, current: list) -> DataFrame:
    folders = [f"{path}/data/version={r['version']}/bucket={r['bucket']}" for r in current]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """Current rows of the table; the list of its buckets passes through the driver, no rows do."""
    return _read(spark, path, schema, current_buckets(spark, path).collect())


def _committed(spark: SparkSession, path: str, version: int) -> bool:
    try:
        return not spark.read.schema("bucket string").parquet(f"{path}/manifest/version={version}").isEmpty()
    except AnalysisException:
        return False


def _merge(spark: SparkSession, path: str, new: DataFrame, version: int, place, merge) -> DataFrame:
    """Rewrite the buckets that ``new`` falls into as ``merge(old rows, new rows)``."""
    buckets = _manifest(spark, path).agg(F.max("buckets")).scalar()
    schema = new.schema
    incoming = pin(new.withColumn("bucket", place(buckets)))
    touched = pin(incoming.select("bucket").distinct())
    if version < 1:
        raise ValueError("version 0 is the table as it was created")
    if _committed(spark, path, version):
        return touched
    before = _manifest(spark, path).where(F.col("version") < version).groupBy("bucket").agg(F.max("version").alias("version"))
    old = _read(spark, path, schema, before.join(touched, "bucket", "left_semi").collect())
    merged = merge(old.withColumn("bucket", place(buckets)), incoming)
    _write(spark, merged.repartition("bucket"), path, version, buckets, touched)
    return touched


def upsert_bucketed(
    spark: SparkSession, path: str, new: DataFrame, key: str, version: int, order: Sequence[str] = ()
) -> DataFrame:
    """``upsert_table`` into a bucketed table as batch ``version`` (1, 2, …); returns the buckets it
    rewrote.  ``new`` has the columns of the table, in any order, and those of ``order`` besides.

    The price of a batch is the content of the buckets that its keys hit.
    """
    rows = new
    if order:
        last = W.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
        rows = new.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", *order)

    def merge(old: DataFrame, incoming: DataFrame) -> DataFrame:
        return upsert_table(old, incoming, key).drop("change")

    return _merge(spark, path, rows, version, lambda n: _bucket(key, n), merge)


def append_bucketed(spark: SparkSession, path: str, new: DataFrame, key: str, ts: str, version: int) -> DataFrame:
    """``append_history`` into a bucketed history: the last row per key and day stays, a later batch
    winning ties.  Only buckets of the batch's own days are read and rewritten."""

    def merge(old: DataFrame, incoming: DataFrame) -> DataFrame:
        both = old.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
        last = W.partitionBy(key, F.to_date(ts)).orderBy(F.col(ts).desc(), F.col("_new").desc())
        return both.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", "_new")

    return _merge(spark, path, new, version, lambda n: _day_bucket(key, ts, n), merge)
