"""All registered queries."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import (  # noqa: F401  (importing a section registers its queries)
    q_aggregates,
    q_clean,
    q_feeds,
    q_ingest,
    q_joins,
    q_models,
    q_scoring,
    q_streams,
    q_text,
    q_timeseries,
)
