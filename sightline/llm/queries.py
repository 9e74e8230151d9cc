"""The registered queries of this package; each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment, decontaminate, fim, html, licenses, lines, minhash, mixing, neighbours, oracles, passages, quality, substring, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without byte strings that earlier ones hold; null texts are empty."""
    return substring.substring_digest(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines within two edits of an earlier line; exact copies of any length go."""
    return lines.line_digest(table(spark, sf_dir, "documents"))


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; null texts have none."""
    return mixing.mixing_digest(table(spark, sf_dir, "documents"))


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every whole text, empty and null ones too."""
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page; null and empty pages give an empty text."""
    return html.main_text(table(spark, sf_dir, "pages"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of texts with at least 85 per cent of their shingles in common."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op7_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words that earlier ones hold."""
    return passages.passage_digest(table(spark, sf_dir, "documents"))


@query
def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of vectors of one label with a cosine of 0.98 or more."""
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of every document lie in windows of benchmark items."""
    return decontaminate.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named or quoted in every whole text."""
    return licenses.license_digest(table(spark, sf_dir, "documents"))


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every whole text, counted over the corpus."""
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text cut into prefix, middle and suffix lines and laid out for infilling."""
    return fim.fim_digest(table(spark, sf_dir, "documents"))
