"""Pieces that several text operators share: column expressions for words and
hashed word windows, range buckets, and written intermediate tables.

All column expressions here are built-in Spark functions. ``let`` keeps a
computed array from being evaluated once per element: Catalyst may move an
expression into a lambda that refers to it, so such values are bound to a
lambda variable first.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage, scratch_path

# White space of the word rule [^\x20\x09-\x0D]+.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    """The words of a text as an array; empty for blank or null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN)))


def window_hashes(word_array: Column, size: int) -> Column:
    """64-bit hash of each window of ``size`` consecutive words (empty if there are fewer words)."""
    empty = F.array().cast("array<bigint>")

    def windows(h: Column) -> Column:
        at = lambda i, d: F.get(h, i + d)
        return F.when(F.size(h) < size, empty).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[at(i, d) for d in range(size)])))

    return let(F.transform(word_array, lambda w: F.xxhash64(w)), windows)


def range_bucket(value: Column, bounds: Sequence[int]) -> Column:
    """Number of ``bounds`` (ascending) that are <= value: a branchless binary search over a literal array."""
    if not bounds:
        return F.lit(0)
    steps = [1 << s for s in reversed(range(len(bounds).bit_length()))]
    array = F.array(*[F.lit(int(b)).cast("bigint") for b in bounds])
    return let(value, lambda v: F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda acc, step: F.when(F.get(array, acc + step - 1) <= v, acc + step).otherwise(acc)))


def key_bounds(df: DataFrame, key: str, n_buckets: int) -> list[int]:
    """Up to ``n_buckets - 1`` distinct ascending split points of an integer column (one aggregate; the list is bounded)."""
    if n_buckets <= 1:
        return []
    probs = [i / n_buckets for i in range(1, n_buckets)]
    got = df.agg(F.percentile_approx(key, probs, max(10_000, 8 * n_buckets)).alias("q")).first()["q"]
    return sorted(set(got or []))


BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def table_writes(spark: SparkSession) -> Iterator[None]:
    """Settings for the actions inside; the session's own are put back.

    Arrow batches of at most BATCH_ROWS rows: texts and sets make rows of kilobytes, and the JVM and the worker each hold
    a whole batch. Shuffle files go when their action ends: its rows are written or collected by then, and an
    executor lost during the action is made up for from its shuffles as ever.
    """
    before = {k: spark.conf.get(k) for k in (_BATCH, _CLEAN)}
    spark.conf.set(_BATCH, str(min(BATCH_ROWS, int(before[_BATCH])) if int(before[_BATCH]) > 0 else BATCH_ROWS))
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def written(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back: later passes neither
    recompute it nor depend on an executor that may be lost."""
    with table_writes(df.sparkSession):
        return cut_lineage(df.select("*"))  # planned anew, under these settings


def sized(df: DataFrame, rows: int, per_partition: int) -> DataFrame:
    """``df``, which comes from about ``rows`` rows, in as many partitions as these need: a small table that is written takes
    no more files than that, however many partitions a shuffle has. All cores have one, and a partition is never split."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_partition)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_scopes: ContextVar[tuple[list[Callable[[], None]], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``kept_table`` and ``for_tasks`` make inside goes at the end, when nothing reads it any more; actions run as in ``table_writes``.

    Frames that leave the block must be written: by ``written``, or by ``kept_table`` with ``stays``, whose table
    goes with the block around this one, if any.
    """
    ends: list[Callable[[], None]] = []
    token = _scopes.set((*_scopes.get(), ends))
    try:
        with table_writes(spark):
            yield
    finally:
        _scopes.reset(token)
        for end in reversed(ends):
            end()


def _at_end(end: Callable[[], None], blocks_out: int = 1) -> None:
    scopes = _scopes.get()
    if len(scopes) >= blocks_out:
        scopes[-blocks_out].append(end)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def for_tasks(spark: SparkSession, value: Any) -> Broadcast:
    """The value (of a bounded size) for all tasks. Every executor keeps a file of it until it is destroyed."""
    out = spark.sparkContext.broadcast(value)
    _at_end(out.destroy)
    return out


def kept_table(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """The frame written as Parquet under the shared checkpoint folder and read back (smaller than a checkpoint)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    _at_end(lambda: _remove(spark, path), 2 if stays else 1)
    with table_writes(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
