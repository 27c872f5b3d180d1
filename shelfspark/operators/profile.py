"""Profiling and grouped statistics. One aggregate pass per
profile, unpivoted with ``stack``: never one scan per column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators.gram import correlations
from shelfspark.operators.ranks import exact_quantiles_from_counts, null_safe_join
from shelfspark.operators.ranks import value_counts as value_count_table
from shelfspark.operators.selection import column_quantiles
from shelfspark.session import materialize


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _stack(pairs: Sequence[tuple[str, Sequence[Column]]], names: Sequence[str], wide: DataFrame) -> DataFrame:
    """Unpivot a one-row (or per-group) wide frame: one output row per entry of ``pairs``."""
    return wide.select(
        F.explode(
            F.array(*[F.struct(F.lit(label).alias(names[0]), *[c.alias(n) for c, n in zip(cols, names[1:])])
                      for label, cols in pairs])
        ).alias("__s")
    ).select("__s.*")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def finite(c: str | Column) -> Column:
    """The value as a double; null for NaN and infinite values."""
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(F.abs(v) < float("inf"), v)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def count_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(c) for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count per value (nulls left out) and share of all rows (the total is a scalar subquery)."""
    total = df.select(F.count(F.lit(1)).cast("double")).scalar()
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter(F.col(column).isNotNull())
    return counts.select(column, "n", (F.col("n") / total).alias("share"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage per column, one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.sum(F.col(c).isNull().cast("long")).alias(f"__n{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    pairs = [(c, [F.col(f"__n{i}"), F.col("__rows")]) for i, c in enumerate(df.columns)]
    out = _stack(pairs, ["column", "nulls", "rows"], wide)
    return out.select(
        "column", "nulls", (F.when(F.col("rows") > 0, F.col("nulls") * 100.0 / F.col("rows"))).alias("pct")
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Column, type, non-null count, plus row and column counts, one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(c)).alias(f"__n{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    n_cols = len(df.columns)
    pairs = [
        (c, [F.lit(df.schema[c].dataType.simpleString()), F.col(f"__n{i}"), F.col("__rows"), F.lit(n_cols)])
        for i, c in enumerate(df.columns)
    ]
    return _stack(pairs, ["column", "dtype", "non_null", "rows", "n_columns"], wide)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max per numeric column; NaN counts as missing.

    The moments come from one aggregate; the quartiles are exact (``selection.py``: ranges are counted and narrowed, rows
    are not shuffled) or ``percentile_approx``. Without numeric columns the result has no rows.
    """
    cols = list(columns or numeric_columns(df))
    spark = df.sparkSession
    schema = "column string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    if not cols:
        return spark.createDataFrame([], schema)
    rows = materialize(df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]), "persist")
    try:
        sums = [x for i in range(len(cols)) for x in (
            F.count(f"x{i}").alias(f"c{i}"), F.avg(f"x{i}").alias(f"m{i}"), F.stddev_samp(f"x{i}").alias(f"s{i}"),
            F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}"))]
        if not exact:
            sums += [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 10000).alias(f"q{i}") for i in range(len(cols))]
        r = rows.agg(*sums).first()
        names = [f"x{i}" for i in range(len(cols))]
        quartiles = column_quantiles(rows, names, [0.25, 0.5, 0.75], keep="none") if exact else {n: r[f"q{i}"] or [None] * 3 for i, n in enumerate(names)}
    finally:
        rows.unpersist()
    out = [(c, r[f"c{i}"], r[f"m{i}"], r[f"s{i}"], r[f"lo{i}"], *quartiles[f"x{i}"], r[f"hi{i}"]) for i, c in enumerate(cols)]
    return spark.createDataFrame(out, schema)


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top (most frequent; smallest on ties), freq per column."""
    cols = list(columns or string_columns(df))
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("__s")
    ).select("__s.*").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v"))).alias("__t"),
    ).select("column", "count", "unique", F.col("__t.v").alias("top"), (-F.col("__t.neg")).alias("freq"))


def crosstab(df: DataFrame, row: str, col: str, labels: Sequence[str] | None = None) -> DataFrame:
    """Contingency counts, zero-filled. Pass ``labels`` to fix the output columns."""
    g = df.groupBy(row).pivot(col, list(labels) if labels is not None else None).agg(F.count(F.lit(1)))
    return g.na.fill(0, subset=[c for c in g.columns if c != row])


def grouped_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def grouped_mean(df: DataFrame, group: str, value: str, z: float = 1.959963984540054) -> DataFrame:
    """Mean per group with a normal 95 % interval (``grouped_mean_bootstrap`` draws one as the plots do)."""
    g = df.groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    half = F.lit(z) * F.col("std") / F.sqrt(F.col("n"))
    return g.select(group, "n", "mean", "std", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


# 16-bit hex words up to which a Poisson(1) weight is 0, 1, 2, ... (its distribution function in 65,536ths, rounded).
POISSON_STEPS = ("5e2d", "bc5b", "eb72", "fb24", "ff10", "ffd9", "fffa")
WORDS_PER_HASH = 8


def poisson_weight(word: Column) -> Column:
    """Poisson(1) weight of a four-digit hex word."""
    out = F.lit(len(POISSON_STEPS))
    for k in reversed(range(len(POISSON_STEPS))):
        out = F.when(word < POISSON_STEPS[k], k).otherwise(out)
    return out


def grouped_mean_bootstrap(df: DataFrame, group: str, value: str, key_cols: Sequence[str], replicates: int = 200, seed: int = 28,
                           level: float = 0.95) -> DataFrame:
    """n, mean and a percentile bootstrap interval of the mean per group, in one pass over the rows.

    A row's weight in a replicate is Poisson(1), read from an md5 of its key, the seed and the replicate: the same under
    any partitioning, and repeatable in SQL. Eight replicates share a hash; a row is dealt to its replicates / 8
    hashes and summed there map-side, so one row per task, group and eight replicates is shuffled. Rows of equal
    keys share their weights (a cluster is drawn as a whole). Null and NaN values are left out; a replicate that draws
    no row of a group has no mean; a null group is a group.
    """
    hashes = -(-replicates // WORDS_PER_HASH)
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    rows = df.select(F.col(group).alias("g"), v.alias("v"), key.alias("k")).filter("v is not null")
    dealt = rows.select("g", "v", "k", F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))).alias("c")).select(
        "g", "v", "c", F.md5(F.concat_ws("|", "k", F.lit(str(seed)), F.col("c").cast("string"))).alias("h"))
    weights = [poisson_weight(F.substring("h", 4 * j + 1, 4)) for j in range(WORDS_PER_HASH)]
    sums = dealt.groupBy("g", "c").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"),
        *[F.sum(w).alias(f"w{j}") for j, w in enumerate(weights)], *[F.sum(w * F.col("v")).alias(f"s{j}") for j, w in enumerate(weights)])
    means = sums.select("g", "c", "n", "mean", F.explode(F.array(*[
        F.struct((F.col("c") * WORDS_PER_HASH + j).alias("b"), F.try_divide(f"s{j}", f"w{j}").alias("m")) for j in range(WORDS_PER_HASH)])).alias("x"))
    used = means.filter(F.col("x.b") < replicates)
    tail = (1 - level) / 2
    ends = F.percentile("x.m", F.array(F.lit(tail), F.lit(1 - tail)))  # of one row per replicate
    out = used.groupBy("g").agg(F.first("n").alias("n"), F.max(F.when(F.col("c") == 0, F.col("mean"))).alias("mean"), ends.alias("e"))
    return out.select(F.col("g").alias(group), "n", "mean", F.col("e")[0].alias("ci_low"), F.col("e")[1].alias("ci_high"))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles (exact), whiskers at 1.5 IQR (most extreme values inside), outlier count per group.

    Both passes read the (group, value) count table, not the rows: a value or group
    holding a third of all rows is one row per task after the map-side combine. The
    quartiles (one row per group) are joined to it; a null group is a group. Null, NaN and infinite values are left out.
    """
    src = df.select(group, finite(value).alias("__v")).filter(F.col("__v").isNotNull())
    vc = value_count_table(src, "__v", [group])
    qs = exact_quantiles_from_counts(vc, [0.25, 0.5, 0.75], by=[group])
    quart = qs.groupBy(group).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"),
    )
    quart = quart.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = null_safe_join(vc, quart, [group], "inner")
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col("v") >= lo_f) & (F.col("v") <= hi_f)
    return j.groupBy(group, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).cast("long").alias("outliers"),
    )


def histogram(df: DataFrame, column: str, n_bins: int = 30) -> DataFrame:
    """Counts in ``n_bins`` equal-width bins between min and max, empty ones included; the last bin is closed.

    Null, NaN and infinite values are in no bin. Equal values only all lie in the first of bins of width 1.
    """
    v = finite(column)
    mm = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, n long")
    width = (hi - lo) / n_bins if hi > lo else 1.0
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(n_bins - 1))
    counts = df.filter(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def density_grid(df: DataFrame, column: str, n_grid: int = 100, bandwidth: float | None = None, cut: float = 3.0,
                 error: float = 1e-4) -> DataFrame:
    """Gaussian kernel density on an even grid from ``cut`` bandwidths below the minimum to as many above the maximum.

    Bandwidth defaults to Scott's rule ``std * n ** (-1/5)`` (1 without spread: a symmetric bump). Every value's mass is split over the two nodes
    of a fine grid next to it (linear binning), nodes are summed map-side, and each one adds its kernel to
    the grid points near it. No density is off by more than ``error`` times the kernel's peak, 1 / (bw sqrt(2 pi)): half of
    it is the bound of linear binning, (width / bw)^2 / 8, which sets the nodes' distance; the other half is what the kernel is cut at.
    Null, NaN and infinite values are left out.
    """
    v = finite(column)
    st = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.stddev_samp(v).alias("sd"), F.count(v).alias("n")).first()
    spark = df.sparkSession
    if not st["n"]:
        return spark.createDataFrame([], "i int, x double, density double")
    lo, hi, n = st["lo"], st["hi"], st["n"]
    bw = bandwidth or ((st["sd"] or 0.0) * n ** (-0.2)) or 1.0
    width = bw * math.sqrt(4 * error)
    reach = bw * math.sqrt(-2 * math.log(error / 2))
    start, stop = lo - cut * bw, hi + cut * bw
    step = (stop - start) / max(1, n_grid - 1)
    at = (v - F.lit(lo)) / F.lit(width)
    node = F.floor("at")
    split = df.select(at.alias("at")).filter("at is not null").select(F.explode(F.array(
        F.struct(node.alias("node"), (1 - (F.col("at") - node)).alias("mass")), F.struct((node + 1).alias("node"), (F.col("at") - node).alias("mass")))).alias("s"))
    nodes = split.groupBy("s.node").agg(F.sum("s.mass").alias("mass")).select((F.lit(lo) + F.col("node") * F.lit(width) - F.lit(start)).alias("x"), "mass")
    first = F.greatest(F.lit(0), F.ceil((F.col("x") - F.lit(reach)) / F.lit(step)).cast("int"))
    last = F.least(F.lit(n_grid - 1), F.floor((F.col("x") + F.lit(reach)) / F.lit(step)).cast("int"))
    near = nodes.filter(first <= last).select("x", "mass", F.explode(F.sequence(first, last)).alias("i"))
    kernel = F.col("mass") * F.exp(-0.5 * F.pow((F.col("i") * F.lit(step) - F.col("x")) / F.lit(bw), 2))
    sums = near.groupBy("i").agg((F.sum(kernel) / F.lit(n * bw * math.sqrt(2 * math.pi))).alias("density"))
    grid = spark.range(n_grid).select(F.col("id").cast("int").alias("i"))
    return grid.join(sums, "i", "left").select("i", (F.lit(start) + F.col("i") * F.lit(step)).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation for every pair (pairwise-complete), from sums of products of deviations (``gram.py``).

    Null where a pair has fewer than two rows or a column without spread in them. A column with itself has 1.
    """
    cols = list(columns or numeric_columns(df))
    r = correlations(df, cols)
    rows = [(a, b, 1.0 if a == b else (None if math.isnan(r[i, j]) else float(r[i, j]))) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def skewness_corrected(c: str | Column) -> Column:
    """Bias-corrected sample skewness (Spark's ``skewness`` is the uncorrected one); null for fewer than three values or
    no spread. NaN counts as missing."""
    col = F.nanvl((F.col(c) if isinstance(c, str) else c).cast("double"), F.lit(None).cast("double"))
    n = F.count(col).cast("double")
    skew = F.skewness(col)
    return F.when((n > 2) & ~F.isnan(skew), skew * F.try_divide(F.sqrt(n * (n - 1)), n - 2))


def row_gate(df: DataFrame, min_rows: int = 1000) -> tuple[bool, int]:
    """True when ``df`` has at least ``min_rows`` rows, and the number of its rows."""
    n = df.count()
    return n >= min_rows, n


def latest_per_key(df: DataFrame, key: Sequence[str], order: str, value: str | Sequence[str],
                   stage: str | None = None, stage_value: str | None = None) -> DataFrame:
    """Newest row per key by ``order``; on ties the largest values, taken from one row.

    With ``stage``, only rows in that stage count (no such row: empty result). Partially aggregated.
    """
    vals = [value] if isinstance(value, str) else list(value)
    rows = df if stage is None else df.filter(F.col(stage) == stage_value)
    newest = rows.groupBy(*key).agg(F.max(F.struct(order, *vals)).alias("__newest"))
    return newest.select(*key, *[F.col(f"__newest.{c}").alias(c) for c in (order, *vals)])
