"""Column expressions for indicators, tags, percents and score bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values ---------------------------------------------------------------------------------
IPV4 = r"^((25[0-5]|2[0-4]\d|1\d\d|0?\d?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|0?\d?\d)$"
SEVERITY_EDGES = (0, 200, 500, 800, 1001)
SEVERITY_LABELS = ("low", "medium", "high", "critical")
COUNT_BUCKETS = ((0, "0"), (5, "1-5"), (10, "6-10"), (25, "11-25"), (50, "26-50"), (100, "51-100"))
THREAT_BANDS = ((700, "Critical"), (400, "High"), (100, "Medium"))
AGENCY_SUFFIX = " Splunk API"
LEGACY_AGENCY_TAG = ("VA CSOC CTS Splunk", "VA Splunk API")
REPORT_FILE_NAMES = (
    r"I&W_Report_([a-zA-Z0-9.-]+\.[a-zA-Z]{2,})\.docx",
    r"I&W_Report_(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\.docx",
)
KNOWN_PARTNERS = ("DHA", "OS", "FDA", "CMS", "VA", "HRSA", "NIH", "IHS", "HHS", "CDC")
GROUP_ID = r"^\d{16}$"
# ----------------------------------------------------------------------------------------------


def indicator_form(value: Column) -> Column:
    """Normal form of an indicator: its first whitespace-separated token."""
    return F.split(F.trim(value), r"\s+")[0]


def blank_to_null(value: Column) -> Column:
    """Blank, none, null and nan count as missing."""
    clean = F.trim(value)
    return F.when(~F.lower(clean).isin("", "none", "null", "nan"), clean)


def percent(value: Column) -> Column:
    """``'85.2%'`` → 85.2; anything else that is not a number → null."""
    return F.rtrim(F.trim(value), F.lit("%")).try_cast("double")


def percent_text(value: Column) -> Column:
    """Share as ``12.34%``: times 100, kept within 0–100, two decimals, halves to even."""
    clipped = F.when(value.isNotNull(), F.least(F.greatest(value * 100, F.lit(0.0)), F.lit(100.0)))
    return F.concat((F.rint(clipped * 100) / 100).cast("string"), F.lit("%"))


def round_scaled(value: Column, places: int = 2) -> Column:
    """``value`` times a power of ten as a double, rounded half away from zero, and divided again, as SQL
    engines and C round; Spark's ``round`` looks at the shortest decimal text of the double instead."""
    scale = F.lit(float(10**places))
    scaled = F.abs(value) * scale
    whole = F.floor(scaled)
    up = whole + F.when(scaled - whole >= 0.5, 1).otherwise(0)
    rounded = F.signum(value) * up / scale
    return F.when(scaled < 2.0**52, rounded + F.lit(0.0)).otherwise(value.cast("double"))


def two_places(value: Column) -> Column:
    """Text with two decimals of the double's exact binary value, exact halves to even, like ``printf``.

    Spark's ``format_string`` rounds the shortest decimal text: 0.125 gives 0.13, not 0.12.
    """
    x = F.abs(value)
    # in two parts of few bits, so that both products with 100 are exact
    high = F.floor(x * 65536.0) / 65536.0
    cents = F.floor(high * 100.0)
    over = (high * 100.0 - cents - 0.5) + (x - high) * 100.0
    cents = cents + F.when((over > 0) | ((over == 0) & (cents % 2 == 1)), 1).otherwise(0)
    digits = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    text = F.concat(F.when(value < 0, "-").otherwise(""), digits)
    # beyond 2^31 a product is no longer exact; NaN and infinities have no digits
    return F.when(x < 2.0**31, text).when(value.isNotNull(), F.format_string("%.2f", value))


def agency_tag(name: Column) -> Column:
    old, new = LEGACY_AGENCY_TAG
    return F.replace(name, F.lit(old), F.lit(new))


def agency_partner(name: Column) -> Column:
    """Partner named by an agency tag: the tag without its suffix."""
    return F.regexp_replace(agency_tag(name), r"\s+Splunk API$", "")


def is_agency_tag(name: Column) -> Column:
    return F.lower(name).contains("api")


def group_id(value: Column) -> Column:
    clean = blank_to_null(value.cast("string"))
    return F.when(clean.rlike(GROUP_ID), clean)


def query_type(value: Column) -> Column:
    """``ip``, ``hostname`` (has a dot) or ``domain``."""
    v6 = r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:[0-9A-Fa-f:.]*$"
    return (
        F.when(value.rlike(IPV4) | value.rlike(v6), "ip")
        .when(value.contains("."), "hostname")
        .otherwise("domain")
    )


def bands(
    value: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "left"
) -> Column:
    """Label of the interval ``value`` falls into; outside all intervals → null."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        if closed == "left":
            inside = (value >= low) & (value < high)
        else:
            inside = (value > low) & (value <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def severity(score: Column, closed: str = "left") -> Column:
    return bands(score, SEVERITY_EDGES, SEVERITY_LABELS, closed)


def count_bucket(n: Column) -> Column:
    out = F.when(n.isNull() | (n < 0), "Unknown")
    for top, label in COUNT_BUCKETS:
        out = out.when(n <= top, label)
    return out.otherwise("100+")


def threat_band(score: Column) -> Column:
    out = F.when(score.isNull(), F.lit(None).cast("string"))
    for floor, label in THREAT_BANDS:
        out = out.when(score >= floor, label)
    return out.otherwise("Low")


def vt_score(explanation: Column) -> Column:
    return F.regexp_extract(explanation, r"VT score:\s*(\d+)", 1).try_cast("long")


def incident_ids(value: Column) -> Column:
    """Upper-cased ``INC…`` ids in order of appearance, without repeats."""
    found = F.regexp_extract_all(value, F.lit(r"(?i)\b(INC\d+)\b"), F.lit(1))
    return F.array_distinct(F.transform(found, F.upper))


def null_if_empty(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def stable_bucket(value: Column, n: int) -> Column:
    """SHA-256 of the text modulo ``n``, folded over 32-bit chunks of the digest."""
    digest = F.sha2(F.trim(value), 256)
    rest = F.lit(0).cast("long")
    for start in range(1, 65, 8):
        chunk = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        rest = (rest * F.lit((1 << 32) % n) + chunk) % F.lit(n)
    return rest
