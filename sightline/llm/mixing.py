"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 3).

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.ordering import add_row_number, running_totals
from sightline.session import pin

WEIGHTS = (5, 2, 1)
BROADCAST_SOURCES = 100_000  # rows of the table of sources that may be broadcast


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def plain_quality(text: str = "text") -> Column:
    """A quality weight from 0.25 to 1: how near the mean word length is to that of prose."""
    mean = F.length(F.col(text).cast("string")) / (word_count(text) + 1)
    return F.coalesce(F.greatest(F.lit(0.25), 1 - F.abs(mean - 6) / 8), F.lit(1.0))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Target words of each source, from (source, source_size).

    Sources in code-point order, null last, take the weights in turn and share ``budget`` times all
    words by weight.  A target stops at ``most`` times its source; what it leaves is shared again
    by weight, until no target is above.  All that a round needs to know is the words per weight of
    the round before, since that tells which sources are full.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranked = add_row_number(sizes, order, "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = pin(ranked.select("source", "source_size", F.col("_rank").alias("source_no"), weight.alias("weight")))
    words, level = ranked.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:
        full = F.lit(level) * F.col("weight") >= F.lit(float(most)) * F.col("source_size")
        taken, left = ranked.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(~full, F.col("weight")).otherwise(0))
        ).first()
        raised = (budget * words - most * (taken or 0)) / left if left else level
        if raised <= level:
            break
        level = raised
    cap, share = F.lit(float(most)) * F.col("source_size"), F.lit(level) * F.col("weight")
    return ranked.withColumn("target", F.least(cap, share))


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, most: float = 2.0, quality: Column | None = None,
    seed: int = 11, text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """Add size, source_size, target, copies and taken to every document.

    Each source takes its target in whole copies of its documents: complete epochs first, then part
    of one more.  For that part the documents come in the order of ``-ln(u) / q``, with u a uniform
    number hashed from id and ``seed`` and q the document's quality weight, so that better documents
    come earlier; their sizes are summed in this order, and those whose middle lies within the rest
    of the target are taken once more.  A source misses its target by half a document at most.

    Sums run over range-partitioned slices, so a source of any size is spread over all tasks; only a
    row per source, counted before it is broadcast, comes back to the documents.  Null sources are
    one source; null texts have size 0 and are never taken; a null or non-positive quality counts as
    1; rows that share an id and size are taken alike.  All columns stay, and one named like an added
    column is replaced.  ``copies`` of null text are 0.
    """
    spark = docs.sparkSession
    q = quality if quality is not None else F.lit(1.0)
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(doc_id).cast("string"))), 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    rows = docs.withColumns({
        "_size": word_count(text), "_source": F.col(source).cast("string"),
        "_place": -F.log(u) / F.coalesce(F.when(q > 0, q.cast("double")), F.lit(1.0)),
        "_id": F.col(doc_id),
    })
    rows = rows.withColumn("_place", F.struct("_place", "_id", "_size")).drop("_id")
    narrow = pin(rows.select("_source", "_size", "_place"))
    sizes = narrow.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    targets = pin(source_targets(sizes, weights, budget, most))
    few = targets.count() <= BROADCAST_SOURCES
    fit = lambda t: F.broadcast(t) if few else t
    numbers = targets.select(F.col("source").alias("_source"), "source_no")
    placed = narrow.join(fit(numbers), narrow["_source"].eqNullSafe(numbers["_source"])).select("source_no", "_size", "_place")
    placed = running_totals(placed, "_place", ["_size"], ["source_no"])
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    targets = targets.withColumn("_epochs", epochs).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    rest = targets.select("source_no", "_rest")
    last = (
        placed.join(fit(rest), "source_no").where(F.col("_size_before") + F.col("_size") / 2 <= F.col("_rest"))
        .groupBy("source_no").agg(F.max("_place").alias("_last"))
    )
    plan = pin(targets.join(last, "source_no", "left").select(
        F.col("source").alias("_key"), F.col("source_size").alias("_words"), F.col("target").alias("_target"), "_epochs", "_last"))
    copies = F.col("_epochs") + F.coalesce(F.col("_place") <= F.col("_last"), F.lit(False)).cast("long")
    copies = F.when(F.col("_size") > 0, copies).otherwise(F.lit(0)).cast("long")
    return rows.join(fit(plan), F.col("_source").eqNullSafe(F.col("_key"))).withColumns({
        "size": F.col("_size"), "source_size": F.col("_words"), "target": F.col("_target"), "copies": copies,
        "taken": copies * F.col("_size"),
    }).drop("_size", "_source", "_place", "_key", "_words", "_target", "_epochs", "_last")


def mixing_digest(docs: DataFrame) -> DataFrame:
    """One row per document with its size, its source's size and target, and the words taken."""
    rows = docs.select("doc_id", "text", "source")
    return mix_sources(rows, quality=plain_quality()).select("doc_id", "size", "source_size", "target", "taken")
