"""Registry and shared pieces of the query catalog."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfspark.session import scratch_path
from shelfspark.sources.testdata import SALES_CTE, sales_view, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Reference period of the retail view: orders up to this date; later ones are the new rows.
CUT = "1999-12-31"


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def with_sales(body: str) -> str:
    """Oracle SQL over the retail view: ``body`` may start with more CTEs (', x AS (...)') or a SELECT."""
    body = body.strip()
    if body.startswith(","):
        return f"WITH {SALES_CTE.strip()}{body}"
    return f"WITH {SALES_CTE.strip()}\n{body}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


__all__ = ["QUERIES", "SQL", "CUT", "register", "with_sales", "scratch", "sales_view", "table"]
