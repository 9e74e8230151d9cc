"""Lists per key in parts of a bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import running_totals

PART_ITEMS = 10_000  # items of a list at most; longer ones go on in the next part


def bounded_lists(rows: DataFrame, keys: Sequence[str], item: Column, out: str, part_items: int = PART_ITEMS) -> DataFrame:
    """(keys, part, n, ``out``): the distinct non-null items of each key in order, as lists of
    ``part_items`` items at most; ``n`` counts the items of the key.

    Items are placed by a range sort over keys and items, in which a key with very many items lies in
    many tasks, so no task ever holds more than a part of a list.  Part 0 is the whole list of a key
    with few items.  Null keys are keys.
    """
    distinct = rows.select(F.struct(*keys).alias("_key"), item.alias("_item")).where("_item IS NOT NULL").distinct()
    placed = running_totals(distinct.withColumn("_one", F.lit(1)), "_item", ["_one"], ["_key"])
    numbered = placed.withColumn("part", F.floor(F.col("_one_before") / part_items).cast("int"))
    lists = numbered.groupBy("_key", "part").agg(
        F.first("_one_all").alias("n"), F.array_sort(F.collect_list("_item")).alias(out))
    return lists.select(*[F.col(f"_key.{k}").alias(k) for k in keys], "part", "n", out)
