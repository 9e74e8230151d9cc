"""Global order without a single-task sort.

A window without partition keys sends every row to one task.  These helpers range-partition
instead: each task numbers its own slice, and only one row per slice (never more than the
number of shuffle partitions) is combined to get the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..session import pin


def add_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number") -> DataFrame:
    """1-based position of every row in the total order ``order``.

    ``order`` should end in a unique key: it breaks ties and lets the range partitioning split a
    value shared by very many rows.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = pin(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        # the generated id holds the partition number above bit 33, the row index below
        .withColumn("_slice", F.shiftright("_id", 33))
    )
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    # one row per shuffle partition, so the broadcast has a fixed bound
    offsets = F.broadcast(sizes.select("_slice", F.coalesce(before, F.lit(0)).alias("_before")))
    index = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        sliced.join(offsets, "_slice")
        .withColumn(out, F.col("_before") + index + 1)
        .drop("_id", "_slice", "_before")
    )


def running_totals(
    df: DataFrame, value: str, cols: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``<c>_before`` (sum over smaller values) and ``<c>_all`` per group.

    ``df`` holds one row per group and value.  Each range-partitioned slice sums on its own; only
    one row per slice and group is combined to get the offsets.
    """
    by = list(by)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = pin(
        df.repartitionByRange(partitions, *[F.col(c) for c in by], F.col(value)).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    slices = sliced.groupBy(*by, "_slice").agg(*[F.sum(c).alias(f"_{c}") for c in cols])
    ordered = W.partitionBy(*by).orderBy("_slice") if by else W.orderBy("_slice")
    whole = W.partitionBy(*by) if by else W.partitionBy()
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    slices = slices.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}_offset") for c in cols],
        *[F.sum(f"_{c}").over(whole).alias(f"{c}_all") for c in cols],
    )
    keys = [*by, "_slice"]
    smaller = W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    before = {
        f"{c}_before": F.col(f"_{c}_offset") + F.coalesce(F.sum(c).over(smaller), F.lit(0)) for c in cols
    }
    return sliced.join(slices, keys).withColumns(before).drop("_slice", *[f"_{c}_offset" for c in cols])


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Linear-interpolated quantiles per group: columns ``q0, q1 …`` plus ``n``.

    With ``weight`` a row stands for that many equal rows.

    The built-in exact percentile keeps a map of all distinct values of a group in one task; here
    equal values are counted first and the counts are range-partitioned, so a group with any
    number of distinct values is spread over all tasks.  Any number of groups is done at once; a null
    group is a group.
    """
    if by:
        # as one struct, a group with nulls equals itself
        packed = df.select(F.struct(*by).alias("_group"), value, *([weight] if weight else []))
        out = _quantiles(packed, value, probabilities, ["_group"], weight)
        return out.select(*[F.col(f"_group.{c}").alias(c) for c in by], *[c for c in out.columns if c != "_group"])
    return _quantiles(df, value, probabilities, [], weight)


def _quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: list[str], weight: str | None
) -> DataFrame:
    rows = F.sum(weight).cast("long") if weight else F.count("*")
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(rows.alias("_n"))
    placed = running_totals(counts, value, ["_n"], by)
    start, total = F.col("_n_before"), F.col("_n_all")

    def at(position: Column) -> Column:
        inside = (start <= position) & (position < start + F.col("_n"))
        return F.max(F.when(inside, F.col(value)))

    aggs = [F.max(total).alias("n")]
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (total - 1)
        aggs += [
            at(F.floor(position)).alias(f"_lo{i}"),
            at(F.ceil(position)).alias(f"_hi{i}"),
            F.max(position - F.floor(position)).alias(f"_w{i}"),
        ]
    out = (placed.groupBy(*by) if by else placed.groupBy()).agg(*aggs)
    quantiles = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")).alias(f"q{i}")
        for i in range(len(probabilities))
    ]
    return out.select(*by, "n", *quantiles)
