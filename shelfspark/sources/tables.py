"""Keyed feature tables: create, overwrite, merge, snapshot; Spark owns the storage.

A table is one Parquet dataset ``<root>/<name>/rows``, partitioned by a bucket of the key's hash, beside a one-row
dataset ``<root>/<name>/about`` with its schema, key, description and number of buckets. A merge joins only the buckets that the new rows
fall into and writes them by dynamic partition overwrite; all others stay as they are. The joined rows are written
to the shared checkpoint folder before they replace a bucket, so no write reads what it replaces.
Spark's commit moves the finished files of a write at its end; readers that list files during that moment can
see some buckets old and some new, and of two writers at once the later one's buckets stay. A table that needs
more (snapshots for readers, several writers) needs a table format in Spark's catalog.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.session import materialize

BUCKET = "key_bucket"
BUCKETS = 32


class KeyError_(ValueError):
    pass


def _rows_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/rows"


def _about_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/about"


def meta(spark: SparkSession, root: str, name: str) -> dict | None:
    """Schema, primary keys, description and buckets of a table; None if there is no such table."""
    try:
        row = spark.read.parquet(_about_path(root, name)).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return {"schema": T.StructType.fromJson(json.loads(row["schema"])), "primary_keys": list(row["primary_keys"]),
            "description": row["description"], "buckets": row["buckets"]}


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return meta(spark, root, name) is not None


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key column is null or a key repeats.

    One grouped aggregate (partially combined map-side): null keys form their own
    groups, so both faults show up as an offending group; the scan stops at the first.
    """
    keys = list(keys)
    bad = " OR ".join(["__n > 1"] + [f"`{k}` IS NULL" for k in keys])
    offender = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(bad).limit(1).collect()
    if offender:
        row = offender[0]
        if any(row[k] is None for k in keys):
            raise KeyError_(f"null in primary key {keys}")
        raise KeyError_(f"duplicate primary key {keys}: {[row[k] for k in keys]}")


def create_keyed_table(spark: SparkSession, root: str, name: str, schema: T.StructType, primary_keys: Sequence[str],
                       description: str = "", df: DataFrame | None = None, buckets: int = BUCKETS) -> bool:
    """Make a table with schema and key. An existing table is reported (False), not replaced.

    ``buckets`` is the unit that a merge rewrites: choose it so that one holds a few files.
    """
    for k in primary_keys:
        if k not in schema.fieldNames():
            raise KeyError_(f"key {k!r} not in schema")
    if BUCKET in schema.fieldNames():
        raise KeyError_(f"{BUCKET!r} is the name of the table's partition column")
    if table_exists(spark, root, name):
        return False
    about = spark.createDataFrame([(schema.json(), list(primary_keys), description, buckets)],
                                  "schema string, primary_keys array<string>, description string, buckets int")
    _store(spark.createDataFrame([], schema), list(primary_keys), buckets, _rows_path(root, name), "overwrite", "static")
    about.coalesce(1).write.mode("error").parquet(_about_path(root, name))
    if df is not None:
        write_table(spark, root, name, df, mode="overwrite")
    return True


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def _store(df: DataFrame, keys: Sequence[str], buckets: int, path: str, mode: str, overwrite: str) -> None:
    """Write rows to their buckets; adaptive execution sizes a bucket's files."""
    dealt = df.select("*", _bucket(keys, buckets)).hint("rebalance", BUCKET)
    dealt.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy(BUCKET).parquet(path)


def _conform(df: DataFrame, schema: T.StructType, allow_missing: bool) -> DataFrame:
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown:
        raise KeyError_(f"columns {unknown} are not in the table's schema")
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif not allow_missing:
            raise KeyError_(f"column {f.name!r} missing")
    return df.select(*cols)


def _known(spark: SparkSession, root: str, name: str) -> dict:
    about = meta(spark, root, name)
    if about is None:
        raise KeyError_(f"no table {name!r}")
    return about


def _bucketed(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(stored).parquet(_rows_path(root, name))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table's rows, with the columns of its schema."""
    return _bucketed(spark, root, name, _known(spark, root, name)["schema"]).drop(BUCKET)


def write_table(spark: SparkSession, root: str, name: str, df: DataFrame, mode: str = "overwrite",
                check: bool = True) -> list[int]:
    """``overwrite`` replaces the content; ``merge`` upserts by the key. Returns the buckets that were written by a merge.

    Merge: rows of a known key take the columns that the new frame has and keep the
    others; rows of a new key have null in columns the new frame lacks. A column
    that the table does not know is an error. Merging the same rows again changes nothing.
    """
    if mode not in ("overwrite", "merge"):
        raise ValueError(f"unknown mode {mode!r}")
    about = _known(spark, root, name)
    schema, keys, buckets = about["schema"], about["primary_keys"], about["buckets"]
    new = _conform(df, schema, allow_missing=(mode == "merge"))
    if check:
        check_keys(new, keys)
    path = _rows_path(root, name)
    if mode == "overwrite":
        _store(new, keys, buckets, path, "overwrite", "static")
        return []
    touched = sorted(r[0] for r in new.select(_bucket(keys, buckets)).distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return []
    old = _bucketed(spark, root, name, schema).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    have = [c for c in new.columns if c not in keys]
    mine = new.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in have], F.lit(True).alias("__in_new"))
    both = old.join(mine, on=keys, how="full")
    merged = materialize(both.select(*[
        F.col(f.name) if f.name not in have else F.when(F.col("__in_new"), F.col(f"__new_{f.name}")).otherwise(F.col(f.name)).alias(f.name)
        for f in schema.fields]), "checkpoint")
    _store(merged, keys, buckets, path, "overwrite", "dynamic")
    return touched


def snapshot_table(df: DataFrame, path: str, job_id: str, snapshot_date: str) -> None:
    """One snapshot per job and day, as partitions ``job_id=/snapshot_date=`` of one table.
    Dynamic partition overwrite replaces only that snapshot on a rerun."""
    (df.withColumn("job_id", F.lit(str(job_id))).withColumn("snapshot_date", F.lit(snapshot_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("job_id", "snapshot_date").parquet(path))


def read_snapshot(spark: SparkSession, path: str, job_id: str, snapshot_date: str) -> DataFrame:
    """Partition pruning: only the folders of that snapshot are listed and read."""
    return (spark.read.parquet(path).filter((F.col("job_id") == str(job_id)) & (F.col("snapshot_date") == snapshot_date))
            .drop("job_id", "snapshot_date"))


def write_predictions(spark: SparkSession, root: str, name: str, df: DataFrame, key: str, mode: str = "overwrite") -> list[int]:
    """Create the predictions table (if new) and write to that same table; ``merge`` adds to what it holds."""
    create_keyed_table(spark, root, name, df.schema, [key], "predictions")
    return write_table(spark, root, name, df, mode)
