"""Exact order statistics of several columns by counting and narrowing ranges.

The first pass takes each column's count, least and largest value. Every further pass cuts the open ranges (those that hold a
wanted rank) into parts, counts the values per (column, range, part) with each part's least and largest value,
and keeps the parts that hold a rank. A range of one value is an answer. What is shuffled are the parts that a
task has met, whatever the number of rows; once the open ranges hold few values, these come to the driver as
value counts. Parts are of equal width; where a pass leaves most of a range in one part, the next one cuts by the
logarithm of the distance from the range's lower or upper end, so values that crowd around either end part soon.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.session import materialize

PARTS = 512
FEW = 20_000  # values that may come to the driver as counts
BITS = 600  # of distance from an end that a logarithmic cut tells apart
EVEN, FROM_LOW, FROM_HIGH = 0, 1, 2


@dataclass
class _Range:
    """Values from low to high: below of the column's values are less, and ranks (0-based) are wanted."""
    low: float
    high: float
    below: int
    count: int
    ranks: list[int]
    cut: int = EVEN


def _part(x: Column, r: _Range) -> Column:
    """The part of a range that a value lies in, which never falls as the value grows."""
    scale = 1.0 if math.isfinite(r.high - r.low) else 0.5
    low, high = F.lit(r.low * scale), F.lit(r.high * scale)
    size = F.lit(r.high * scale - r.low * scale)
    if r.cut == EVEN:
        return F.least(F.floor((x * scale - low) / size * PARTS), F.lit(PARTS - 1)).cast("int")
    away = (x * scale - low) / size if r.cut == FROM_LOW else (high - x * scale) / size
    depth = F.floor(F.log2(1 + away * F.lit(2.0 ** BITS)) / F.lit(BITS + 1.0) * PARTS).cast("int")
    return depth if r.cut == FROM_LOW else F.lit(PARTS) - depth


def _choose(x: Column, ranges: Sequence[_Range], value, low: int = 0, high: int | None = None) -> Column:
    """``value(number, range)`` of the range that holds x, by binary search over the ranges' ends; null between ranges."""
    high = len(ranges) if high is None else high
    if high - low == 1:
        r = ranges[low]
        return F.when((x >= F.lit(r.low)) & (x <= F.lit(r.high)), value(low, r))
    mid = (low + high) // 2
    return F.when(x < F.lit(ranges[mid].low), _choose(x, ranges, value, low, mid)).otherwise(_choose(x, ranges, value, mid, high))


def _open_values(rows: DataFrame, names: Sequence[str], ranges: dict[str, list[_Range]], place) -> DataFrame:
    """c (column number), x and s (``place`` of the column, the range's number and the range) of every value in an open range."""
    each = [F.struct(F.lit(i).alias("c"), F.col(n).alias("x"), _choose(F.col(n), ranges[n], lambda k, r, n=n: place(F.col(n), k, r)).alias("s"))
            for i, n in enumerate(names) if ranges[n]]
    return rows.select(F.explode(F.array(*each)).alias("e")).select("e.c", "e.x", "e.s").filter("s is not null")


def _deal(r: _Range, parts: list[tuple[int, float, float]], answers: dict[int, float]) -> list[_Range]:
    """The parts (count, least, largest), in order, that hold a rank and more than one value; ranks of one-value parts are answered."""
    out, below = [], r.below
    for count, least, largest in parts:
        ranks = [k for k in r.ranks if below <= k < below + count]
        if ranks and least == largest:
            answers.update((k, least) for k in ranks)
        elif ranks:
            crowded = count * 2 > r.count
            out.append(_Range(least, largest, below, count, ranks, (r.cut + 1) % 3 if crowded else EVEN))
        below += count
    return out


def column_order_statistics(df: DataFrame, columns: Sequence[str], wanted, keep: str = "persist") -> dict[str, tuple[int, dict[int, float]]]:
    """Per column its number of values n and {rank: value} of the ranks (0-based) that ``wanted(n)`` names.

    Null and NaN are no values; infinite ones are. With ``keep`` "persist" the columns are kept (memory and
    executors' disks) while the passes read them.
    """
    cols = list(columns)
    names = [f"x{i}" for i in range(len(cols))]
    rows = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(n) for c, n in zip(cols, names)])
    if keep != "none":
        rows = materialize(rows, keep)
    infinite = float("inf")
    try:
        inner = lambda n: F.when(F.abs(F.col(n)) < infinite, F.col(n))
        first = rows.agg(*[x for n in names for x in (
            F.count(n).alias(f"n{n}"), F.count(inner(n)).alias(f"f{n}"), F.count(F.when(F.col(n) == -infinite, 1)).alias(f"l{n}"),
            F.min(inner(n)).alias(f"lo{n}"), F.max(inner(n)).alias(f"hi{n}"))]).first()
        answers: dict[str, dict[int, float]] = {}
        ranges: dict[str, list[_Range]] = {}
        for n in names:
            count, low, inside = first[f"n{n}"], first[f"l{n}"], first[f"f{n}"]
            ranks = sorted(set(wanted(count))) if count else []
            answers[n] = {k: -infinite if k < low else infinite for k in ranks if not low <= k < low + inside}
            rest = [k for k in ranks if low <= k < low + inside]
            whole = _Range(first[f"lo{n}"], first[f"hi{n}"], low, inside, rest) if rest else None
            ranges[n] = _deal(whole, [(inside, whole.low, whole.high)], answers[n]) if whole else []
            for r in ranges[n]:
                r.cut = EVEN
        while any(ranges.values()):
            if sum(r.count for rs in ranges.values() for r in rs) <= FEW:
                _finish(rows, names, ranges, answers)
                break
            ranges = _narrowed(rows, names, ranges, answers)
    finally:
        if keep != "none":
            rows.unpersist()
    return {c: (first[f"n{n}"], answers[n]) for c, n in zip(cols, names)}


def _narrowed(rows: DataFrame, names: Sequence[str], ranges: dict[str, list[_Range]], answers: dict[str, dict[int, float]]) -> dict[str, list[_Range]]:
    """One pass: the open ranges cut into parts, and those parts kept that hold a rank."""
    open_values = _open_values(rows, names, ranges, lambda x, k, r: F.struct(F.lit(k).alias("k"), _part(x, r).alias("p")))
    counts = open_values.groupBy("c", "s.k", "s.p").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    found: dict[tuple[int, int], list] = {}
    for r in sorted(counts, key=lambda r: (r["c"], r["k"], r["p"])):
        found.setdefault((r["c"], r["k"]), []).append((r["n"], r["lo"], r["hi"]))
    return {n: [x for k, r in enumerate(ranges[n]) for x in _deal(r, found[i, k], answers[n])] for i, n in enumerate(names)}


def _finish(rows: DataFrame, names: Sequence[str], ranges: dict[str, list[_Range]], answers: dict[str, dict[int, float]]) -> None:
    """The last pass: the few values of the open ranges come as counts."""
    open_values = _open_values(rows, names, ranges, lambda x, k, r: F.lit(k)).withColumnRenamed("s", "k")
    below: dict[tuple[int, int], int] = {}
    for r in sorted(open_values.groupBy("c", "k", "x").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: (r["c"], r["k"], r["x"])):
        own = ranges[names[r["c"]]][r["k"]]
        start = below.setdefault((r["c"], r["k"]), own.below)
        answers[names[r["c"]]].update((k, r["x"]) for k in own.ranks if start <= k < start + r["n"])
        below[r["c"], r["k"]] = start + r["n"]


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keep: str = "persist") -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation (as ``percentile``) per column, in the order of ``probs``; None without values."""
    def wanted(n: int) -> list[int]:
        return [k for p in probs for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))]

    out: dict[str, list[float | None]] = {}
    for c, (n, at) in column_order_statistics(df, columns, wanted, keep).items():
        out[c] = []
        for p in probs:
            if not n:
                out[c].append(None)
                continue
            h = (n - 1) * p
            low, high = at[math.floor(h)], at[math.ceil(h)]
            out[c].append(low if low == high else low + (high - low) * (h - math.floor(h)))
    return out
