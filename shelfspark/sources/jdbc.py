"""Remote tables through Spark's JDBC reader.

The date filter is written before any action, so Catalyst pushes it into the
remote query (``PushedFilters``); with a numeric partition column and bounds
the read runs as ``num_partitions`` parallel range queries. Credentials are
arguments only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str | None = None,
    date_col: str | None = None,
    after: str | None = None,
    until: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("user", user).option("password", password).option("fetchsize", fetch_size))
    if driver:
        reader = reader.option("driver", driver)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    df = reader.load()
    if date_col and after:
        df = df.filter(F.col(date_col) > F.lit(after))
    if date_col and until:
        df = df.filter(F.col(date_col) <= F.lit(until))
    return df
