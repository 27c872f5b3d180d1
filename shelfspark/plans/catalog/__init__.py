"""Registered queries over the driver's tables, each with its DuckDB oracle where SQL can express it.

Every query reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from shelfspark.plans.catalog import (  # noqa: F401  (import registers)
    q_features,
    q_io,
    q_model,
    q_profile,
    q_stats_drift,
    q_stream,
    q_transform,
)
from shelfspark.plans.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
