"""Registered queries over the given tables."""

from tickerloom.plans import (  # noqa: F401
    cohort_queries,
    ml_queries,
    performance_queries,
    quality_queries,
    series_queries,
    source_queries,
)  # noqa: F401
from tickerloom.plans.registry import ORACLES, QUERIES, ROWS  # noqa: F401
