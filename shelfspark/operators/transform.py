"""Projections, filters, key joins, sorts and set operations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.scalar import recode, set_when_in


# ---- projections -----------------------------------------------------------

def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*list(columns))


def constant_column(df: DataFrame, name: str, value: Any, first: bool = True) -> DataFrame:
    """Tag or date column; placed in front by default. The value is an argument so runs repeat."""
    out = df.withColumn(name, F.lit(value))
    return reorder_first(out, [name]) if first else out


def add_row_id(df: DataFrame, name: str, key_cols: Sequence[str] | None = None, method: str = "md5") -> DataFrame:
    """Id column in front.

    With ``key_cols`` the id is a hash of the business key, stable across reruns
    and partitionings: ``md5`` (the whole digest as text: unique in practice at any
    size and repeatable in SQL engines), or ``xxhash64`` (a bigint; 64 bits repeat
    by chance from about 1e9 rows on). Without, ``monotonically_increasing_id``
    as the feature tables use it: unique but neither dense nor stable.
    """
    if key_cols and method == "md5":
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
        ident = F.md5(text)
    elif key_cols:
        ident = F.xxhash64(*[F.col(c) for c in key_cols])
    else:
        ident = F.monotonically_increasing_id()
    return df.select(ident.alias(name), *[F.col(c) for c in df.columns if c != name])


def reorder_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def recode_column(df: DataFrame, column: str, mapping: Mapping[Any, Any]) -> DataFrame:
    return df.withColumn(column, recode(column, mapping))


def conditional_set(df: DataFrame, target: str, test: str, values: Iterable[Any], new_value: Any) -> DataFrame:
    return df.withColumn(target, set_when_in(target, test, values, new_value))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast by name; with ``strict=False`` dirty text becomes null (``try_cast``)."""
    cols = []
    for c in df.columns:
        if c in types:
            cols.append((F.col(c).cast(types[c]) if strict else F.col(c).try_cast(types[c])).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# ---- filters and splits ----------------------------------------------------

def filter_eq(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_null(df: DataFrame, column: str, is_null: bool = True) -> DataFrame:
    return df.filter(F.col(column).isNull() if is_null else F.col(column).isNotNull())


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def split_by_date(
    df: DataFrame, date_col: str, cut: str, start: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Reference rows ``start <= d <= cut``, current rows ``d > cut``.

    ``cut`` and ``start`` are ``yyyy-MM-dd``. Both filters are plain column
    predicates, so they reach the Parquet / JDBC scan as pushed filters.
    """
    d = F.col(date_col)
    ref_cond = d <= F.lit(cut).cast("date")
    if start is not None:
        ref_cond = ref_cond & (d >= F.lit(start).cast("date"))
    return df.filter(ref_cond), df.filter(d > F.lit(cut).cast("date"))


def split_by_tag(df: DataFrame, tag_col: str, train_value: Any, test_value: Any) -> tuple[DataFrame, DataFrame]:
    t = F.col(tag_col)
    return df.filter(t == F.lit(train_value)).drop(tag_col), df.filter(t == F.lit(test_value)).drop(tag_col)


# ---- key joins -------------------------------------------------------------

def lookup_join(
    df: DataFrame,
    table: DataFrame,
    key: str,
    value: str,
    out: str | None = None,
    default: Any = None,
) -> DataFrame:
    """Per-row dictionary lookup with a default. The planner broadcasts the table by its bytes at run time or shuffles."""
    out = out or value
    small = table.select(F.col(key), F.col(value).alias("__lookup_value"))
    joined = df.join(small, on=key, how="left")
    looked = F.col("__lookup_value")
    if default is not None:
        looked = F.coalesce(looked, F.lit(default))
    if out in df.columns:
        cols = [looked.alias(out) if c == out else F.col(c) for c in df.columns]
    else:
        cols = [F.col(c) for c in df.columns] + [looked.alias(out)]
    return joined.select(*cols)


def semi_filter(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on=on, how="left_semi")


def anti_filter(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on=on, how="left_anti")


def isin_filter(df: DataFrame, column: str, values: Iterable[Any]) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def column_concat(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Side by side by an explicit row key (pandas aligned on its index); a key of one side only has nulls on the other."""
    return left.join(right, on=key, how="full")


# ---- sorts, limits, sets ---------------------------------------------------

def sort_limit(df: DataFrame, order: Sequence[str | Column], n: int, last: bool = False) -> DataFrame:
    """First (or last) ``n`` rows in ``order``; Spark plans a top-k, no full sort."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    cols = [c.desc() for c in cols] if last else [c.asc() for c in cols]
    return df.orderBy(*cols).limit(n)


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def dedupe_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
