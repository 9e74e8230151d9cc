"""Readers, writers and table maintenance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import indicator_form
from ..operators.components import components
from ..operators.lists import PART_ITEMS, bounded_lists
from ..operators.ordering import add_row_number
from ..schemas import DAILY_REPORT, OBSERVATION
from ..session import pin, small


def _csv(spark: SparkSession, schema: StructType):
    return spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)


def scan_daily_files(
    spark: SparkSession, root: str, start: str, end: str, schema: StructType = OBSERVATION
) -> DataFrame:
    """Day files ``…dYYYYMMDD.csv`` (files or folders) from ``start`` to ``end``.

    Only the wanted days are listed and read; days without a file are skipped, and a range
    without any file gives an empty table.
    """
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    days = [first + timedelta(n) for n in range((last - first).days + 1)]
    names = ",".join(f"{day:%Y%m%d}" for day in days)
    try:
        rows = _csv(spark, schema).csv(f"{root}/*d{{{names}}}.csv")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema).withColumn("file_date", F.lit(None).cast("date"))
        return rows
    found = F.regexp_extract("_metadata.file_path", r"d(\d{8})\.csv", 1)
    return rows.withColumn("file_date", F.to_date(found, "yyyyMMdd"))


def scan_report_tree(
    spark: SparkSession, root: str, day: str | None = None, exclude: Sequence[str] = (),
    schema: StructType = DAILY_REPORT,
) -> DataFrame:
    """All ``<partner>/<name>YYYYMMDD.csv`` under a tree with ``Partner`` and ``FileDate``.

    A path is taken apart once per file, and not once per row, in a table of files that is joined back.
    """
    rows = _csv(spark, schema).csv(root).withColumn("_file", F.col("_metadata.file_path"))
    path = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    # a match begins where a part of the path does; tried from every letter, long paths cost their square
    pattern = r"(?:^|/)([^/]+)/[^/]*?(\d{8})\.csv(?:/|$)"
    located = rows.select("_file").distinct().withColumn("_path", path).withColumns(
        {
            "Partner": F.regexp_replace(F.regexp_extract("_path", pattern, 1), "^[^=]*=", ""),
            "FileDate": F.to_date(F.nullif(F.regexp_extract("_path", pattern, 2), F.lit("")), "yyyyMMdd"),
        }
    )
    kept = located.where("FileDate IS NOT NULL")
    for name in exclude:
        kept = kept.where(~F.col("_path").contains(f"/{name}/"))
    if day:
        kept = kept.where(F.col("FileDate") == F.lit(day).cast("date"))
    return rows.join(small(kept.drop("_path")), "_file").drop("_file")


def read_json_records(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """JSON lines, or with ``multi_line`` one JSON array or object per file."""
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def flatten_record(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to flat columns named by their path; arrays are kept."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                out += leaves(field.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def clean_observations(df: DataFrame, drop_users: Sequence[str] = ()) -> DataFrame:
    """Normal-form indicators, trimmed partners, typed day; audit columns dropped."""
    out = df.drop("curr_date", "indicator_key").withColumns(
        {
            "indicator": indicator_form(F.col("indicator")),
            "OpDiv": F.trim("OpDiv"),
            "obs_date": F.to_date("obs_date"),
        }
    )
    if drop_users:
        out = out.where(~F.coalesce(F.col("API_UserName").isin(*drop_users), F.lit(False)))
    return out


def merge_incremental(existing: DataFrame, new: DataFrame, day_col: str, key: Sequence[str]) -> DataFrame:
    """Append only the days that ``existing`` does not hold yet, one row per key."""
    days = small(existing.select(day_col).distinct())
    fresh = new.join(days, day_col, "left_anti").dropDuplicates(list(key))
    return existing.unionByName(fresh, allowMissingColumns=True)


def split_by_partner(
    existing: DataFrame, new: DataFrame, col: str, path: str, rows_per_file: int = 5_000_000
) -> None:
    """One Parquet folder per partner with the distinct rows of both tables.

    ``path`` must not be a path that ``existing`` reads from.  Rows stay spread by the hash of the
    distinct, so a large partner is written by all tasks.
    """
    rows = existing.unionByName(new).distinct()
    writer = rows.write.mode("errorifexists").partitionBy(col)
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """``mode='ignore'`` leaves an existing table as it is."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def validate_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def table_profile(df: DataFrame) -> DataFrame:
    """Row count, column count and column names."""
    return df.agg(F.count("*").alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), F.lit(",".join(df.columns)).alias("names")
    )


def upsert_table(old: DataFrame, new: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Keep unchanged, replace changed, add new and preserve absent rows, with ``change``.

    When ``new`` repeats a key, the last row in ``order`` wins.
    """
    if order:
        last = W.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
        new = new.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")
    cols = [c for c in old.columns if c != key]
    before = old.select(key, F.struct(*cols).alias("_old"), F.lit(True).alias("_in_old"))
    after = new.select(key, F.struct(*cols).alias("_new"), F.lit(True).alias("_in_new"))
    change = (
        F.when(F.col("_in_old").isNull(), "added")
        .when(F.col("_in_new").isNull(), "preserved")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("updated")
    )
    merged = F.when(F.col("_in_new"), F.col("_new")).otherwise(F.col("_old"))
    both = before.join(after, key, "full_outer").select(key, merged.alias("_row"), change.alias("change"))
    return both.select(key, "_row.*", "change")


def append_history(old: DataFrame, new: DataFrame, key: str, ts: str) -> DataFrame:
    """Append a run, keep the last row per key and day, sorted by key and newest first."""
    both = old.withColumn("_new", F.lit(0)).unionByName(
        new.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    last = W.partitionBy(key, F.to_date(ts)).orderBy(F.col(ts).desc(), F.col("_new").desc())
    kept = both.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", "_new")
    return kept.orderBy(key, F.col(ts).desc())


def group_documents(
    old: DataFrame, new: DataFrame, key: str, parts: int | None = None, part_items: int = PART_ITEMS
) -> DataFrame:
    """Distinct records of both tables as sorted lists: (key, part, records).

    A list has ``part_items`` records at most; a key with more has further parts, which lie in other
    tasks.  With ``parts`` the records of every key are dealt by their hash into so many lists instead.
    """
    rows = old.unionByName(new)
    record = F.struct(*[c for c in rows.columns if c != key])
    if parts is None:
        return bounded_lists(rows, (key,), record, "records", part_items).drop("n")
    numbered = rows.distinct().withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)).cast("int"))
    return numbered.groupBy(key, "part").agg(F.array_sort(F.collect_list(record)).alias("records"))


def dedupe_library(df: DataFrame, order: str = "ingest_order") -> DataFrame:
    """Latest record per (kind, term, address, source of preferred sources); later ties win."""
    preferred = F.when(F.col("kind") == "preferred-source", F.coalesce("source", F.lit(""))).otherwise("")
    address = F.coalesce(F.nullif("url_normalized", F.lit("")), F.col("url"), F.lit(""))
    keys = [F.coalesce("kind", F.lit("")), F.coalesce("term", F.lit("")), address, preferred]
    newest = W.partitionBy(*keys).orderBy(
        F.coalesce("saved_at", F.lit("")).desc(), F.col(order).desc()
    )
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


FOLD_ARTICLES = 100_000  # articles of a component that are decided in one task


def _decide(table: pa.Table) -> pa.Table:
    """The articles of one component in order: each is accepted unless an accepted one has its title or
    address."""
    rows = table.sort_by([("_order", "ascending")])
    titles, urls, kept = set(), set(), []
    for i, (title, url) in enumerate(zip(rows.column("_title").to_pylist(), rows.column("_url").to_pylist())):
        if title not in titles and url not in urls:
            titles.add(title)
            urls.add(url)
            kept.append(i)
    return rows.select(["_order"]).take(pa.array(kept, pa.int64()))


def _leaders(left: DataFrame) -> DataFrame:
    """Articles that come first for both their title and their address."""
    first = left
    for c in ("_title", "_url"):
        first = first.join(left.groupBy(c).agg(F.min("_order").alias(f"_first{c}")), c).where(f"_order = _first{c}").drop(f"_first{c}")
    return first


def skip_known_articles(
    stored: DataFrame, new: DataFrame, order: str = "ingest_order", fold_articles: int = FOLD_ARTICLES
) -> DataFrame:
    """New articles whose title and URL are both unseen, numbered after the stored ones.

    Within the batch an article is also skipped when an earlier *accepted* one has its title or
    URL.  ``order`` is unique.  A first round accepts the articles that come first for both and removes
    what they rule out, which settles titles and addresses that very many articles share.  The rest is
    a graph in which articles tie a title to an address: its connected components know nothing of each
    other, and each is decided by going through its articles in order, a chain of any length within
    its component at once.  Only components of more than ``fold_articles`` articles go on in rounds.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    fresh = new.where(~blank("title") & ~blank("url"))
    for c in ("title", "url"):
        fresh = fresh.join(stored.select(c).where(f"{c} IS NOT NULL").distinct(), c, "left_anti")
    fresh = pin(fresh)
    # narrow rows: digests stand for titles and addresses
    digest = lambda c: F.md5(F.col(c).cast("binary"))
    left = pin(fresh.select(F.col(order).alias("_order"), digest("title").alias("_title"), digest("url").alias("_url")))
    accepted = left.select("_order").limit(0)

    def settle(left: DataFrame, accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
        chosen = pin(_leaders(left).select("_order", "_title", "_url"))
        for c in ("_title", "_url"):
            left = left.join(chosen.select(c), c, "left_anti")
        return pin(left), accepted.unionByName(chosen.select("_order"))

    left, accepted = settle(left, accepted)
    while not left.isEmpty():
        ends = [F.xxhash64(F.lit(c), c) for c in ("_title", "_url")]
        edges = left.select(ends[0].alias("u"), ends[1].alias("v"))
        named = pin(left.withColumn("id", ends[0]).join(components(edges), "id").drop("id"))
        sizes = named.groupBy("component").agg(F.count("*").alias("_n"))
        named = named.join(sizes, "component")
        kind = new.schema[order].dataType.simpleString()
        small = named.where(F.col("_n") <= fold_articles).drop("_n")
        accepted = accepted.unionByName(small.groupBy("component").applyInArrow(_decide, f"_order {kind}"))
        left = pin(named.where(F.col("_n") > fold_articles).select("_order", "_title", "_url"))
        if not left.isEmpty():
            left, accepted = settle(left, accepted)
    chosen = fresh.join(accepted, fresh[order] == accepted["_order"], "left_semi").select(*new.columns)
    numbered = add_row_number(chosen, [F.col(order).asc()], "_rn")
    start = stored.agg(F.count("*")).scalar()
    return numbered.withColumn("text_id", start + F.col("_rn") - 1).drop("_rn")
