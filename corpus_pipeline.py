"""Documents to a training mix: quality, line dedup, near-dedup, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import decontaminate, lines, minhash, mixing, quality
from sightline.session import scratch_path

#: no SQL twin: the first stage is a fitted model; tests compare the rows that each stage keeps, and the
#: texts of the lines stage, with plain Python over whole texts (tests/llm/test_pipeline.py)
ORACLE_SQL = None


def _carried(docs: DataFrame, *apart: str) -> DataFrame:
    """``docs`` with the columns ``apart`` and all others under names that no operator adds."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in apart else f"_kept{i}") for i, c in enumerate(docs.columns)])


def _restored(rows: DataFrame, docs: DataFrame, *apart: str) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`" if c in apart else f"_kept{i}").alias(c) for i, c in enumerate(docs.columns)])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones, does not reject."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score_quality(_carried(docs, "doc_id", "text"), model).where("predicted = 1")
    return _restored(scored, docs, "doc_id", "text")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones, by two edits or, if they are short, exactly; a
    document that loses all its words goes.  A null text becomes empty."""
    done = lines.dedup_lines(_carried(docs, "doc_id", "text", "n_chars"), exact=1)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    kept = done.where(~emptied).withColumn("n_chars", F.length("text").cast("long"))
    return _restored(kept, docs, "doc_id", "text", "n_chars")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.drop_near_duplicates(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies."""
    return mixing.mix_sources(docs, quality=mixing.plain_quality()).where("copies > 0")


STAGES = [
    ("quality", good_quality),
    ("lines", without_repeated_lines),
    ("near-duplicates", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("mix", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
