"""Broadcast only a side whose size is bounded by how it is built.

A table with one row per listed column or per range bucket has a known row count, and is
broadcast without running anything. Every other join is left to the planner, which
compares bytes at run time (``spark.sql.autoBroadcastJoinThreshold`` under AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few numbers each: a few megabytes.
MAX_KNOWN_ROWS = 100_000


def broadcast_known(df: DataFrame, bound_rows: int, max_rows: int = MAX_KNOWN_ROWS) -> DataFrame:
    """Broadcast a side of a few numeric columns whose row count is at most ``bound_rows`` by construction."""
    return F.broadcast(df) if bound_rows <= max_rows else df
