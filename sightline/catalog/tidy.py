"""Make results comparable: doubles to six places, dates as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = 6


def tidy(df: DataFrame, *cols: str, long: Sequence[str] = ()) -> DataFrame:
    out = []
    for name in cols or df.columns:
        kind = df.schema[name].dataType.simpleString()
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.round(c.cast("double"), PLACES)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("date").cast("string")
        elif kind == "array<string>":
            c = F.array_join(c, "|")
        elif kind.startswith("array<") and kind[6:-1] in ("int", "bigint"):
            c = F.array_join(c.cast("array<string>"), "|")
        elif kind in ("int", "smallint", "tinyint", "bigint"):
            c = c.cast("long")
        out.append(c.alias(name))
    return df.select(*out)


def r(expression: str) -> str:
    """SQL twin of the rounding; adding zero turns a negative zero into zero."""
    return f"(round(CAST({expression} AS DOUBLE), {PLACES}) + 0.0)"


def i(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def d(expression: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS VARCHAR)"
