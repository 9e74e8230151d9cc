"""The most similar dictionary items of each text, by an index of cells over the items' vectors.

Items lie in the cell of the nearest of a bounded number of pivots.  The angle between a text and an
item is at least the text's angle to the pivot less the cell's radius, so a text visits only the
cells that this bound leaves open, and misses nothing; or it visits a stated number of nearest cells.
Keywords are found once per text by an automaton, and meet the items through lists of the items that
hold a keyword, so only hits cost anything.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin
from .phrases import phrase_matches

PIVOTS = 4_096  # cells at most; their pivots and radii are broadcast

# fixed values ---------------------------------------------------------------------------------
TACTIC_HINTS = {
    "command-and-control": ("network", "traffic"),
    "initial-access": ("initially access", "entry point"),
}
# ----------------------------------------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    """Rows of a list column; equal lengths are the vectors' contract."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(vectors) @ pivots.T, -1.0, 1.0))


def _usable(df: DataFrame) -> DataFrame:
    """Rows whose vector has only finite components and some that are not zero."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.withColumn("vector", v.cast("array<double>")).where(v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def _cells(sent, which: str):
    """Add the item's own cell and its angle to the pivot, or the cells that a text visits."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = _angles(_matrix(batch.column(batch.num_columns - 1)), sent.value["pivots"])
            cell = angles.argmin(axis=1) if len(angles) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(angles[np.arange(len(cell)), cell], pa.float64())],
                [*batch.schema.names, "cell", "angle"])

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radii, limit, probes = sent.value["radii"], sent.value["limit"], sent.value["probes"]
        for batch in batches:
            angles = _angles(_matrix(batch.column(batch.num_columns - 1)), sent.value["pivots"])
            if probes is None:
                rows, cells = np.nonzero(angles - radii <= limit)
            else:
                cells = np.argsort(np.where(radii >= 0, angles, np.inf), axis=1, kind="stable")[:, :probes]
                rows, cells = np.repeat(np.arange(len(cells)), cells.shape[1]), cells.ravel()
                open_ = radii[cells] >= 0
                rows, cells = rows[open_], cells[open_]
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells, pa.int32())], [*batch.schema.names, "cell"])

    return nearest if which == "nearest" else visited


def _best(threshold: float, boost: float, k: int, schema: pa.Schema):
    def step(texts: pa.Table, items: pa.Table) -> pa.Table:
        """The best ``k`` items of one block for each text of one slot of a cell."""
        if not len(texts) or not len(items):
            return schema.empty_table()
        left, right = _matrix(texts.column("vector")), _matrix(items.column("vector"))
        sim = left @ right.T / np.outer(np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1))
        exact, folded = np.zeros(sim.shape), np.zeros(sim.shape, bool)
        holders: dict[str, list[int]] = {}
        holders_folded: dict[str, list[int]] = {}
        for lists, index in ((items.column("keywords"), holders), (items.column("folded"), holders_folded)):
            for j, words in enumerate(lists.to_pylist()):
                for word in words:
                    index.setdefault(word, []).append(j)
        for i, hits in enumerate(texts.column("hits").to_pylist()):
            for word in hits:
                if word in holders:
                    np.add.at(exact[i], holders[word], 1)
                if word in holders_folded:
                    folded[i, holders_folded[word]] = True
        names = sorted(TACTIC_HINTS)
        given = np.array([[t in x for t in names] for x in texts.column("tactics").to_pylist()], np.float64)
        listed = np.array([[x.count(t) for t in names] for x in items.column("tactics").to_pylist()], np.float64)
        sim += boost * folded
        final, shown = np.round(sim + boost * exact + 0.05 * (given @ listed.T), 2), np.round(sim, 3)
        keys = np.array(items.column("item_id").to_pylist(), object)
        order = np.empty(len(keys), np.int64)
        order[np.array(sorted(range(len(keys)), key=lambda j: keys[j]))] = np.arange(len(keys))
        ids, found = texts.column("id").to_pylist(), []
        for i, row in enumerate(sim):
            kept = np.flatnonzero(row >= threshold)
            best = kept[np.lexsort((order[kept], -shown[i, kept], -final[i, kept]))][:k]
            found += [{"id": ids[i], "item_id": keys[j], "similarity": shown[i, j], "final_score": final[i, j]} for j in best]
        return pa.Table.from_pylist(found, schema)

    return step


def similar_items(
    texts: DataFrame, dictionary: DataFrame, threshold: float = 0.9, boost: float = 0.1, k: int = 5,
    text_rows: int = 1_000, block_rows: int = 4_000, probes: int | None = None,
) -> DataFrame:
    """The ``k`` most similar dictionary items per text by cosine, keyword and tactic hints.

    ``texts`` has ``id`` (unique), ``text`` and ``vector``; ``dictionary`` has ``item_id, keywords,
    tactics, vector``.  A keyword in the text, ignoring case, adds ``boost`` to the cosine, which must
    then reach ``threshold``; each keyword as written and each tactic hinted at add to the final score.
    All matches are found, unless ``probes`` limits each text to so many nearest cells.

    The texts of a cell meet its items in slots of ``text_rows`` and blocks of ``block_rows``, so a
    crowded cell is many tasks; a task returns at most ``k`` rows per text.  Vectors that are null,
    zero or not finite match nothing.
    """
    none = F.array().cast("array<string>")
    keyed = F.coalesce("keywords", none)
    items = _usable(dictionary.select(
        "item_id", keyed.alias("keywords"), F.transform(keyed, F.lower).alias("folded"), F.coalesce("tactics", none).alias("tactics"),
        "vector"))
    key, item = (df.schema[c].dataType.simpleString() for df, c in ((texts, "id"), (dictionary, "item_id")))
    out = f"id {key}, item_id {item}, similarity double, final_score double"
    spark = texts.sparkSession
    chosen = max(1, min(PIVOTS, math.isqrt(items.count())))
    pivots = items.orderBy(F.xxhash64("item_id"), "item_id").limit(chosen).select("vector").collect()
    if not pivots:
        return spark.createDataFrame([], out + ", rank int")
    shared = {"pivots": _unit(np.array([r["vector"] for r in pivots], np.float64))}
    schema = "item_id {}, keywords array<string>, folded array<string>, tactics array<string>, vector array<double>, cell int, angle double"
    placed = pin(items.mapInArrow(_cells(spark.sparkContext.broadcast(shared), "nearest"), schema.format(item)))
    cells = placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect()  # at most PIVOTS
    radii = np.full(len(pivots), -np.inf)
    for c in cells:
        radii[c["cell"]] = c["radius"]
    cut = min(1.0, max(-1.0, threshold - max(boost, 0.0)))
    sent = spark.sparkContext.broadcast(shared | {"radii": radii, "limit": math.acos(cut) + 1e-6, "probes": probes})

    lowered = F.lower(F.coalesce("text", F.lit("")))
    words = dictionary.select(F.explode("keywords").alias("_word"))
    words = words.select(F.explode(F.array("_word", F.lower("_word"))).alias("_phrase")).where("_phrase <> ''").distinct()
    hits = phrase_matches(texts.select("id", "text"), words, lowered).groupBy("id").agg(F.collect_set("_phrase").alias("_hits"))
    hinted = F.array_compact(F.array(*[
        F.when(F.array_contains(F.transform(F.array(*map(F.lit, cues)), lambda cue: F.contains(lowered, cue)), True), name)
        for name, cues in TACTIC_HINTS.items()]))
    ready = _usable(texts.select("id", hinted.alias("tactics"), "vector")).join(hits, "id", "left")
    # the empty keyword stands in every text
    ready = ready.select("id", F.array_append(F.coalesce("_hits", none), "").alias("hits"), "tactics", "vector")
    visits = pin(ready.mapInArrow(_cells(sent, "visited"), f"id {key}, hits array<string>, tactics array<string>, vector array<double>, cell int"))

    size = {c["cell"]: c["n"] for c in cells}
    shape = [
        (r["cell"], max(1, math.ceil(r["n"] / text_rows)), max(1, math.ceil(size[r["cell"]] / block_rows)))
        for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()  # at most PIVOTS
    ]
    shape = F.broadcast(spark.createDataFrame(shape, "cell int, slots int, blocks int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = visits.join(shape, "cell").withColumn("slot", F.pmod(F.xxhash64("id"), "slots").cast("int")).withColumn("block", every("blocks"))
    offered = placed.drop("angle").join(shape, "cell").withColumn("block", F.pmod(F.xxhash64("item_id"), "blocks").cast("int"))
    offered = offered.withColumn("slot", every("slots"))
    group = ("cell", "slot", "block")
    fields = spark.createDataFrame([], out).schema
    found = asked.drop("slots", "blocks").groupBy(*group).cogroup(offered.drop("slots", "blocks").groupBy(*group)).applyInArrow(
        _best(threshold, boost, k, _arrow(fields)), fields)
    rank = F.row_number().over(
        W.partitionBy("id").orderBy(F.col("final_score").desc(), F.col("similarity").desc(), F.col("item_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _arrow(fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)
