"""Explicit schemas of the domain tables; no reader infers types."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE, DATE, TS = (
    T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# API_UserName has up to 20 digits and leading zeros, so it stays text.
OBSERVATION = struct(
    indicator=STRING, API_UserName=STRING, obs_date=DATE, OpDiv=STRING,
    indicator_key=STRING, observations=LONG, curr_date=DATE,
)
TAG = struct(id=LONG, name=STRING, lastUsed=TS, description=STRING)
GROUP = struct(id=STRING, type=STRING, name=STRING, ownerName=STRING)
ENRICHMENT = struct(
    type=STRING, vtMaliciousCount=LONG, hostNames=T.ArrayType(STRING),
    domains=T.ArrayType(STRING), tags=T.ArrayType(STRING), country=STRING, city=STRING,
    isp=STRING, asn=STRING, org=STRING, openPorts=T.ArrayType(LONG),
)
RECORD = struct(
    id=LONG, summary=STRING, type=STRING, ownerName=STRING, dateAdded=TS, lastModified=TS,
    lastObserved=TS, rating=DOUBLE, confidence=DOUBLE, observations=LONG, falsePositives=LONG,
    threatAssessScore=DOUBLE, calScore=DOUBLE, description=STRING, tags=T.ArrayType(TAG),
    associatedGroups=T.ArrayType(GROUP), enrichment=T.ArrayType(ENRICHMENT),
)
TAG_DIMENSION = struct(
    indicator=STRING, type=STRING, orig_tag=STRING, tag=STRING, threat_category=STRING,
    nation_state=STRING, security_organization=STRING, malware_class=STRING, cve_nbr=STRING,
)
SCORE_HISTORY = struct(
    scoring_date=TS, indicator=STRING, indicator_type=STRING, score=T.IntegerType(),
    severity=STRING, explanation=STRING,
)
TRACKING = struct(
    id=LONG, name=STRING, lastUsed=TS, description=STRING, summary=STRING, observations=LONG,
)
DAILY_REPORT = T.StructType(
    [T.StructField("Indicator", STRING), T.StructField("Observed Today", T.IntegerType())]
    + [T.StructField(f"Frequency ({d}d)", LONG) for d in (1, 7, 30)]
    + [
        T.StructField(f"{kind}: {h}-Day", STRING)
        for h in (1, 7, 14, 30)
        for kind in ("Probability", "Confidence")
    ]
)
