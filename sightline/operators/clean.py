"""Projection, filtering and scalar clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import columns as fx
from .ordering import exact_quantiles


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def fill_missing(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, list(subset) if subset else None)


def dedupe_rows(
    df: DataFrame, subset: Sequence[str] | None = None, order: Sequence[str] = (), keep: str = "first"
) -> DataFrame:
    """Distinct rows, or one row per ``subset``: the first or last in the explicit ``order``.

    Spark trims each partition to one row per key before the shuffle, so a hot key is cheap.
    """
    if not subset:
        return df.distinct()
    if not order:
        raise ValueError("keeping one row per key needs an explicit order")
    columns = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order]
    first = W.partitionBy(*subset).orderBy(*columns)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def outlier_threshold(df: DataFrame, col: str, threshold: float) -> DataFrame:
    return df.where(F.col(col) < threshold)


def outlier_iqr(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Flag values outside ``Q1 − k·IQR … Q3 + k·IQR``."""
    quartiles = exact_quantiles(df, col, (0.25, 0.75))
    limits = quartiles.select(
        F.struct(
            (F.col("q0") - k * (F.col("q1") - F.col("q0"))).alias("low"),
            (F.col("q1") + k * (F.col("q1") - F.col("q0"))).alias("high"),
        )
    ).scalar()
    return df.withColumn("is_outlier", (F.col(col) < limits["low"]) | (F.col(col) > limits["high"]))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def extract_numeric(df: DataFrame, col: str) -> DataFrame:
    """First run of digits as a number; none → null."""
    digits = F.regexp_extract(F.col(col).cast("string"), r"(\d+)", 1)
    return df.withColumn(col, digits.try_cast("long"))


def cast_datetime(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    text = F.col(col).cast("string")
    parsed = F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
    return df.withColumn(col, parsed)


def cast_numeric(df: DataFrame, col: str) -> DataFrame:
    """Numbers that do not parse, and NaN, become null."""
    value = F.trim(F.col(col).cast("string")).try_cast("double")
    return df.withColumn(col, F.when(~F.isnan(value), value))


def cast_string(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("string"))


def cast_category(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Add ``<col>_code``: the position in the ordered categories, null outside them."""
    code = F.array_position(F.array(*map(F.lit, order)), F.col(col)) - 1
    return df.withColumn(f"{col}_code", F.when(code >= 0, code))


def lower(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.lower(col))


def upper(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.upper(col))


def strip(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.trim(col))


def split_column(df: DataFrame, col: str, delimiter: str, new_columns: Sequence[str]) -> DataFrame:
    """Split on a literal delimiter; missing parts are null, extra parts are dropped."""
    parts = F.split(F.col(col), "\\Q" + delimiter + "\\E")
    return df.withColumns({name: F.get(parts, i) for i, name in enumerate(new_columns)})


def parse_percent(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, fx.percent(F.col(col)))


def format_percent(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, fx.percent_text(F.col(col)))


def canonical_agency_tag(df: DataFrame, col: str) -> DataFrame:
    """Replace the legacy tag name and add ``partner``."""
    return df.withColumn(col, fx.agency_tag(F.col(col))).withColumn(
        "partner", fx.agency_partner(F.col(col))
    )


def normalize_group_id(df: DataFrame, col: str) -> DataFrame:
    """Blank-like → null; only 16-digit ids qualify."""
    return df.withColumn(col, fx.group_id(F.col(col)))


def first_group_id(df: DataFrame, col: str = "associatedGroups", out: str = "group_id") -> DataFrame:
    """First qualifying id among the associated groups."""
    ids = F.filter(F.transform(col, lambda g: g["id"].cast("string")), lambda v: v.rlike(fx.GROUP_ID))
    return df.withColumn(out, F.get(ids, 0))


def classify_query_type(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("query_type", fx.query_type(F.col(col)))


def is_ipv4(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("is_ipv4", F.coalesce(F.col(col).rlike(fx.IPV4), F.lit(False)))


def date_or_na(df: DataFrame, col: str) -> DataFrame:
    day = F.date_format(F.try_to_timestamp(F.col(col).cast("string")), "yyyy-MM-dd")
    return df.withColumn(col, F.coalesce(day, F.lit("N/A")))


def coalesce_columns(df: DataFrame, out: str, candidates: Sequence[str]) -> DataFrame:
    """First non-null of the candidate columns that exist."""
    present = [F.col(c) for c in candidates if c in df.columns]
    return df.withColumn(out, F.coalesce(*present) if present else F.lit(None))


def extract_incident_ids(
    df: DataFrame, text_col: str = "description", groups: str = "associatedGroups",
    kinds: Sequence[str] = ("incident", "event"), out: str = "incident_label",
) -> DataFrame:
    """One label listing incident and event groups, then incident ids named in the text."""
    wanted = F.filter(
        F.coalesce(F.col(groups), F.array()), lambda g: F.lower(g["type"]).isin(*kinds)
    )
    labels = F.transform(
        wanted, lambda g: F.concat(F.initcap(g["type"]), F.lit(":"), F.coalesce(g["id"], g["name"]))
    )
    ids = F.coalesce(fx.incident_ids(F.col(text_col)), F.array().cast("array<string>"))
    named = F.transform(ids, lambda i: F.concat(F.lit("Incident:"), i))
    return df.withColumn(out, F.nullif(F.array_join(F.concat(labels, named), ";"), F.lit("")))


def extract_vt_score(df: DataFrame, col: str = "explanation") -> DataFrame:
    return df.withColumn("vt_score", fx.vt_score(F.col(col)))


def report_indicator_from_name(df: DataFrame, col: str) -> DataFrame:
    """Distinct indicators (domain, else address) named in report file names."""
    found = [F.nullif(F.regexp_extract(F.col(col), p, 1), F.lit("")) for p in fx.REPORT_FILE_NAMES]
    return df.select(F.coalesce(*found).alias("indicator")).where("indicator IS NOT NULL").distinct()


def bucket_scores(
    df: DataFrame, col: str, edges: Sequence[float] = fx.SEVERITY_EDGES,
    labels: Sequence[str] = fx.SEVERITY_LABELS, closed: str = "left", out: str = "severity",
) -> DataFrame:
    return df.withColumn(out, fx.bands(F.col(col), edges, labels, closed))


def bucket_counts(df: DataFrame, col: str, out: str = "count_bucket") -> DataFrame:
    return df.withColumn(out, fx.count_bucket(F.col(col)))


def bucket_threat_band(df: DataFrame, col: str, out: str = "threat_band") -> DataFrame:
    return df.withColumn(out, fx.threat_band(F.col(col)))


