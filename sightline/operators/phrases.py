"""Literal phrases in texts, found by an automaton over all phrases at once.

The distinct phrases are dealt by hash into shares of bounded size.  The phrases of one share become
one Aho-Corasick automaton, which is broadcast; every text is then read once, from left to right, on
Arrow batches, however many phrases there are.  No characters, anchors or pairs are made into rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin, scratch_path

SHARE_CHARS = 4_000_000  # characters of the phrases of one automaton, at most about 200 MB in memory


def _automaton(phrases: list[str], values: list[int] | None = None):
    """Automaton that answers a phrase with its value, or with its place in the list."""
    import ahocorasick

    built = ahocorasick.Automaton()
    for place, phrase in enumerate(phrases):
        built.add_word(phrase, place if values is None else values[place])
    if phrases:
        built.make_automaton()
    return built


def _matches(phrases, text: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per text and phrase that it holds; the lowered text is taken off again."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = phrases.value
        built = _automaton(names)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            rows, found = [], []
            for row, value in enumerate(batch.column(at).to_pylist() if names else ()):
                hits = {place for _, place in built.iter(value)} if value else ()
                rows += [row] * len(hits)
                found += [names[place] for place in sorted(hits)]
            kept = batch.take(pa.array(rows, pa.int64()))
            columns = [c for i, c in enumerate(kept.columns) if i != at]
            names_out = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], [*names_out, "_phrase"])

    return step


def phrase_matches(texts: DataFrame, phrases: DataFrame, text: Column, share_chars: int = SHARE_CHARS) -> DataFrame:
    """Rows of ``texts`` with ``_phrase``, once for each row of ``phrases`` (one distinct, non-empty
    string column ``_phrase``) that stands literally in ``text``.

    The characters of the phrases are summed first.  One share's matches are a lazy plan; more shares
    pass over the texts one after the other, each writing its matches to the shared folder before the
    next automaton is built, so that only one is alive.
    """
    spark = texts.sparkSession
    phrases = pin(phrases.select("_phrase"))
    chars, longest = phrases.agg(F.sum(F.length("_phrase")), F.max(F.length("_phrase"))).first()
    if (longest or 0) > share_chars:
        raise ValueError("a phrase is longer than a share")
    # half full on the average, since phrases are dealt by hash
    shares = 1 if (chars or 0) <= share_chars else math.ceil(2 * chars / share_chars)
    lowered = texts.withColumn("_text", text)
    schema = texts.withColumn("_phrase", F.lit("")).schema
    paths = []
    for share in range(shares):
        own = phrases.where(F.pmod(F.xxhash64("_phrase"), F.lit(shares)) == share) if shares > 1 else phrases
        sent = spark.sparkContext.broadcast(sorted(r["_phrase"] for r in own.collect()))
        matched = lowered.mapInArrow(_matches(sent, "_text"), schema)
        if shares == 1:
            return matched
        paths.append(scratch_path(spark, f"phrases-{share}"))
        matched.write.parquet(paths[-1])
        sent.destroy()
    return spark.read.schema(schema).parquet(*paths)


def least_match(texts: DataFrame, needles: dict[str, int], text: Column, out: str) -> DataFrame:
    """``out``: the least number of the needles that stand in ``text``, null if none does.

    The needles are a parameter, not a table.
    """
    words = sorted(needles)
    numbers = [needles[w] for w in words]
    schema = texts.withColumn(out, F.lit(None).cast("int")).schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = _automaton(words, numbers)
        for batch in batches:
            values = batch.column(batch.num_columns - 1).to_pylist()
            least = [min((n for _, n in built.iter(v)), default=None) if v and words else None for v in values]
            names = [*batch.schema.names[:-1], out]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(least, pa.int32())], names)

    return texts.withColumn("_text", text).mapInArrow(step, schema)
