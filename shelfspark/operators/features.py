"""Feature engineering: fit tables first, apply them lazily.

Fits are actions that return small results (a mode table, five cut points);
applying them is a lookup join or a ``when`` chain,
so the frame being transformed is never gathered anywhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.scalar import code_lookup, safe_name
from shelfspark.operators.ranks import exact_quantiles
from shelfspark.operators.sizing import broadcast_known
from shelfspark.session import cut_lineage, scratch_path

# ---- modes -------------------------------------------------------------------


def group_mode(df: DataFrame, key: str | Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent non-null ``value`` per key; the smallest value on ties.

    Two aggregations, both partially aggregated map-side: (key, value) counts,
    then the minimum of (-count, value) per key. A key with a third of all rows
    is combined per task before the shuffle; the buffer per key is one struct,
    not the set of its distinct values (as the ``mode`` aggregate would hold).
    """
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("__n")).alias("neg"), F.col(value).alias("v"))).alias("__m"))
    return best.select(*keys, F.col("__m.v").alias(out))


def global_mode_frame(df: DataFrame, value: str, out: str = "mode") -> DataFrame:
    """One-row frame with the column mode (smallest on ties; null if all null)."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    return counts.agg(F.min(F.struct((-F.col("__n")).alias("neg"), F.col(value).alias("v"))).alias("__m")).select(
        F.col("__m.v").alias(out)
    )


def global_mode(df: DataFrame, value: str) -> Any:
    row = global_mode_frame(df, value).first()
    return None if row is None else row["mode"]


@dataclass
class ModeImputer:
    """Fitted per-key modes plus the global fallback."""

    key: str
    value: str
    table: DataFrame  # (key, mode)
    global_mode: Any

    def apply(self, df: DataFrame, fallback: Any = "frame") -> DataFrame:
        return mode_impute_apply(df, self.table, self.key, self.value, fallback=fallback)


def mode_impute_fit(
    train: DataFrame,
    key: str,
    value: str,
    only_keys_with_gaps: bool = True,
    fill_train: bool = True,
    train_fallback: Any = 0.0,
) -> tuple[DataFrame, ModeImputer]:
    """Fit per-key modes on ``train``; return the filled train frame and the imputer.

    The table holds the keys that have gaps in ``train`` (all keys with
    ``only_keys_with_gaps=False``); a key without any value gets the global mode.
    Train rows are filled with their key's mode, ``train_fallback`` when the key
    has no value (``fill_train=False`` leaves the gaps, as the faulty fill did).
    """
    # One pass: (key, value) counts with nulls give the key modes, the keys with gaps and the global mode. The counts are
    # written, so neither the later passes nor a lost executor make them again.
    counts = cut_lineage(train.groupBy(key, value).agg(F.count(F.lit(1)).alias("__n")))
    there = F.col(value).isNotNull()
    per_key = counts.groupBy(key).agg(
        F.min(F.when(there, F.struct((-F.col("__n")).alias("neg"), F.col(value).alias("v")))).alias("__m"),
        F.max((~there).cast("int")).alias("__gaps")).select(key, F.col("__m.v").alias("mode"), "__gaps")
    totals = counts.filter(there).groupBy(value).agg(F.sum("__n").alias("__n"))
    best = totals.agg(F.min(F.struct((-F.col("__n")).alias("neg"), F.col(value).alias("v"))).alias("__m")).first()["__m"]
    gmode = None if best is None else best["v"]
    fill = F.lit(gmode).cast(train.schema[value].dataType) if gmode is not None else F.lit(None)
    listed = per_key.filter("__gaps = 1") if only_keys_with_gaps else per_key
    table = listed.select(key, F.coalesce(F.col("mode"), fill).alias("mode"))
    modes = per_key.filter(F.col("mode").isNotNull()).select(key, "mode")
    if fill_train:
        filled = _fill_from(train, modes, key, value, F.lit(train_fallback))
    else:
        filled = train
    return filled, ModeImputer(key, value, table, gmode)


def _fill_from(df: DataFrame, table: DataFrame, key: str, value: str, fallback: Column) -> DataFrame:
    small = table.select(F.col(key), F.col("mode").alias("__mode"))
    joined = df.join(small, on=key, how="left")
    dtype = df.schema[value].dataType
    filled = F.coalesce(F.col(value), F.col("__mode").cast(dtype), fallback.cast(dtype))
    return joined.select(*[filled.alias(c) if c == value else F.col(c) for c in df.columns])


def mode_impute_apply(
    df: DataFrame, table: DataFrame, key: str, value: str, fallback: Any = "frame"
) -> DataFrame:
    """Fill nulls from the fitted table; else ``fallback``.

    ``fallback="frame"`` uses the mode of ``df`` itself, computed once before
    filling. A stream cannot aggregate first: pass the saved global mode.
    """
    if isinstance(fallback, str) and fallback == "frame":
        # Scalar subquery: evaluated once inside the same lazy plan, no driver round trip.
        fb = global_mode_frame(df, value).scalar()
    else:
        fb = F.lit(fallback)
    return _fill_from(df, table, key, value, fb)


def mode_impute_overwrite(df: DataFrame, key: str, value: str) -> DataFrame:
    """Notebook variant: every row of a key that has a gap gets the key's mode."""
    modes = group_mode(df, key, value)
    gap_keys = df.filter(F.col(value).isNull()).select(key).distinct()
    table = gap_keys.join(modes, on=key, how="inner").select(key, F.col("mode").alias("__mode"))
    joined = df.join(table, on=key, how="left")
    dtype = df.schema[value].dataType
    return joined.select(
        *[F.coalesce(F.col("__mode").cast(dtype), F.col(value)).alias(c) if c == value else F.col(c) for c in df.columns]
    )


# ---- quantile bins -----------------------------------------------------------


class EqualEdgesError(ValueError):
    pass


def quantile_bin_fit(df: DataFrame, column: str, n_bins: int = 4, n_buckets: int | None = None) -> list[float]:
    """Exact quantile edges (linear interpolation), ``n_bins + 1`` ascending values."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    cuts = exact_quantiles(df, column, probs, n_buckets)
    if any(c is None for c in cuts):
        raise ValueError(f"column {column!r} has no values to bin")
    if len(set(cuts)) != len(cuts):
        raise EqualEdgesError(f"quantile edges of {column!r} are not distinct: {cuts}")
    return [float(c) for c in cuts]


def quantile_bin_expr(c: str | Column, cuts: Sequence[float], round_cuts: int | None = None) -> Column:
    """Bin label 1..n: right-closed; values below the range go to 1, above to n; null stays null."""
    col = F.col(c) if isinstance(c, str) else c
    edges = [round(x, round_cuts) if round_cuts is not None else x for x in cuts]
    inner = edges[1:-1]
    expr = F.when(col.isNull(), F.lit(None).cast("int"))
    for i, e in enumerate(inner, start=1):
        expr = expr.when(col <= F.lit(float(e)), F.lit(i))
    return expr.otherwise(F.lit(len(inner) + 1))


def quantile_bin_apply(df: DataFrame, column: str, cuts: Sequence[float], out: str | None = None,
                       round_cuts: int | None = None) -> DataFrame:
    return df.withColumn(out or column, quantile_bin_expr(column, cuts, round_cuts))


# ---- encoders ----------------------------------------------------------------


def ordinal_encode(df: DataFrame, column: str, codes: Mapping[Any, int], out: str | None = None) -> DataFrame:
    """Label to integer code; labels not in ``codes`` become null."""
    return df.withColumn(out or column, code_lookup(column, codes, "int"))


def one_hot_fixed(df: DataFrame, column: str, labels: Sequence[Any], prefix: str | None = None,
                  drop: bool = True) -> DataFrame:
    """A 0/1 int column per listed label, named ``<prefix>_<label>`` with blanks as underscores."""
    prefix = prefix or column
    col = F.col(column)
    dummies = [F.coalesce((col == F.lit(lab)).cast("int"), F.lit(0)).alias(f"{prefix}_{safe_name(lab)}") for lab in labels]
    base = [F.col(c) for c in df.columns if not (drop and c == column)]
    return df.select(*base, *dummies)


def one_hot_inferred(df: DataFrame, column: str, max_labels: int = 1000, prefix: str | None = None,
                     drop: bool = True) -> tuple[DataFrame, list[Any]]:
    """Labels taken from the data (sorted); refuses more than ``max_labels`` output columns."""
    labels = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"{column!r} has more than {max_labels} labels; pass them explicitly")
    labels = sorted(labels)
    return one_hot_fixed(df, column, labels, prefix, drop), labels


def label_index(df: DataFrame, column: str) -> DataFrame:
    """label, index (dense, from 0, in order of the labels) of the column's distinct non-null values; any number of them.

    The labels are range-sorted over the shuffle partitions and written with their place in a partition; a label's index is
    its place plus the labels of earlier partitions, so no list of labels reaches the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    labels = df.select(F.col(column).alias("label")).filter("label is not null").distinct()
    ordered = labels.repartitionByRange(parts, "label").sortWithinPartitions("label")
    path = scratch_path(spark, f"labels-{uuid.uuid4().hex[:12]}")
    ordered.select("label", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")).write.parquet(path)
    dealt = spark.read.parquet(path)
    runs = dealt.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per shuffle partition
    starts = runs.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(broadcast_known(starts, parts), "part").select("label", (F.col("at") + F.col("shift")).alias("index"))


def one_hot_sparse(df: DataFrame, column: str, index: DataFrame | None = None, drop: bool = True) -> DataFrame:
    """One-hot columns of any number of labels as ``<column>_ones``: the array of places that hold a 1, all others hold 0.

    A label's place is its ``label_index`` (of the data, or the one given, to encode new rows as the fitted ones); null and unknown labels have no
    place, as they have no 1 in the wide form. The rows are joined to the index by label as the planner sees fit.
    """
    table = (label_index(df, column) if index is None else index).select(F.col("label").alias("__label"), F.col("index").alias("__index"))
    joined = df.join(table, F.col(column) == F.col("__label"), "left")
    ones = F.when(F.col("__index").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("__index")).alias(f"{column}_ones")
    return joined.select(*[F.col(c) for c in df.columns if not (drop and c == column)], ones)


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Contingency counts of any number of labels: row, col, the column label's place (``label_index``) and n; pairs that do not occur
    have no row. Null labels of ``col`` are left out, a null in ``row`` is a group."""
    counts = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n")).filter(F.col(col).isNotNull())
    places = label_index(df, col).select(F.col("label").alias("__label"), F.col("index").alias("col_index"))
    return counts.join(places, F.col(col) == F.col("__label")).select(row, col, "col_index", "n")
