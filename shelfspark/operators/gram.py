"""Centred cross-product sums of many columns, in generated code.

Two passes: the first takes counts and means, the second sums of products of deviations from them, so values far from
zero keep their digits. Plain sums of products stay in whole-stage code, unlike one covariance aggregate per pair. A
wide table is cut into blocks of columns: a row is dealt to its pairs of blocks, and every pair is one group
of at most WIDTH x WIDTH sums, so the aggregate stays below the limit of generated code for any number of
columns. What is shuffled are one row per task and pair of blocks, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 8
MOST_SUMS = 90  # of one aggregate; Spark generates code for up to 100 fields


@dataclass
class Gram:
    """Rows, means and sums of products of deviations of the named columns."""
    columns: list[str]
    n: int
    means: np.ndarray
    sums: np.ndarray


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def cross_sums(df: DataFrame, columns: Sequence[Column], others: Sequence[Column] | None = None) -> np.ndarray:
    """Sums of ``columns[i] * others[j]`` over all rows (of ``columns`` with themselves if ``others`` is not given)."""
    same = others is None
    left, right = list(columns), list(columns if same else others)
    n, m = len(left), len(right)
    out = np.zeros((n, m))
    wanted = _pairs(n) if same else [(i, j) for i in range(n) for j in range(m)]
    if len(wanted) <= MOST_SUMS:
        row = df.select(*[c.alias(f"l{i}") for i, c in enumerate(left)], *([] if same else [c.alias(f"r{j}") for j, c in enumerate(right)]))
        b = "l" if same else "r"
        got = row.agg(*[F.sum(F.col(f"l{i}") * F.col(f"{b}{j}")).alias(f"s{k}") for k, (i, j) in enumerate(wanted)]).first()
        for k, (i, j) in enumerate(wanted):
            out[i, j] = got[k] or 0.0
    else:
        block = lambda cols, a: F.array(*[cols[a + k] if a + k < len(cols) else F.lit(0.0) for k in range(WIDTH)])
        deals = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), block(left, a).alias("l"), block(right, b).alias("r"))
                 for a in range(0, n, WIDTH) for b in range(a if same else 0, m, WIDTH)]
        dealt = df.select(F.explode(F.array(*deals)).alias("d")).select(
            "d.a", "d.b", *[F.col("d.l")[k].alias(f"l{k}") for k in range(WIDTH)], *[F.col("d.r")[k].alias(f"r{k}") for k in range(WIDTH)])
        sums = [F.sum(F.col(f"l{i}") * F.col(f"r{j}")).alias(f"s{i}_{j}") for i in range(WIDTH) for j in range(WIDTH)]
        for r in dealt.groupBy("a", "b").agg(*sums).collect():  # one row per pair of blocks
            for i in range(min(WIDTH, n - r["a"])):
                for j in range(min(WIDTH, m - r["b"])):
                    out[r["a"] + i, r["b"] + j] = r[f"s{i}_{j}"] or 0.0
    if same:
        low = np.tril_indices(n, -1)
        out[low] = out.T[low]
    return out


def gram(df: DataFrame, columns: Sequence[str]) -> Gram:
    """The Gram matrix of the rows that have no null in any of the columns."""
    names = list(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).dropna()
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(names))]).first()
    if not first["n"]:
        return Gram(names, 0, np.zeros(len(names)), np.zeros((len(names), len(names))))
    means = np.array([first[f"m{i}"] for i in range(len(names))])
    away = [F.col(f"x{i}") - F.lit(float(means[i])) for i in range(len(names))]
    return Gram(names, int(first["n"]), means, cross_sums(rows, away))


def correlations(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson correlations of all pairs of columns over the rows that have both values; NaN where there is none.

    Deviations from each column's own mean are summed over a pair's rows and centred again by the pair's own
    sums, so columns with gaps need the same second pass as columns without.
    """
    names = list(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(names))],
                     *[F.count(f"x{i}").alias(f"c{i}") for i in range(len(names))]).first()
    means = [first[f"m{i}"] or 0.0 for i in range(len(names))]
    away = [F.coalesce(F.col(f"x{i}") - F.lit(float(means[i])), F.lit(0.0)) for i in range(len(names))]
    cross = cross_sums(rows, away)
    if all(first[f"c{i}"] == first["n"] for i in range(len(names))):
        spread = np.sqrt(np.diag(cross))
        with np.errstate(divide="ignore", invalid="ignore"):
            return cross / np.outer(spread, spread)
    there = [F.col(f"x{i}").isNotNull().cast("double") for i in range(len(names))]
    both = cross_sums(rows, there)
    shift = cross_sums(rows, away, there)  # [i, j]: deviations of i over the rows that have j
    square = cross_sums(rows, [a * a for a in away], there)
    with np.errstate(divide="ignore", invalid="ignore"):
        covariance = cross - shift * shift.T / both
        spread = square - shift * shift / both
        return covariance / np.sqrt(spread * spread.T)
