"""Data drift between a reference period and new rows.

One scan builds a long value-count table ``(feature, v, n_ref, n_cur)`` for
all columns at once (partially aggregated, so hot values collapse map-side).
Every distance is then an aggregate over that table; CDFs use the bucketed
prefix sums of ``ranks.py``. Only one row per column reaches the driver.

Test choice per column, the same at every size: normed Wasserstein for numeric
columns with more than 5 values, Jensen-Shannon for the rest (numeric binned by
Sturges' rule); drift when the distance >= 0.1. ``DriftRules.tests`` names another
test for a column: ks, chisquare or z (drift when p < 0.05). Only if
``DriftRules.small_reference_rows`` is set, references of up to that many rows are
tested by KS, chi-square (more than 2 values) or z instead.

Every column gets a row. ``status`` is ``ok``, ``no_values`` (null in both periods: no
drift), ``no_reference_values`` or ``no_current_values`` (null in one period only: drift).
A category that the reference lacks is expected with the share ``zero_share``. A column
with one value in both periods has a z of 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.distributions import chi2_sf, ks_2samp_pvalue, norm_sf
from shelfspark.operators.ranks import cumulative_counts
from shelfspark.operators.sizing import broadcast_known
from shelfspark.session import materialize


@dataclass(frozen=True)
class DriftRules:
    small_reference_rows: int | None = None
    tests: tuple[tuple[str, str], ...] = ()  # (column, test)
    few_values: int = 5
    p_threshold: float = 0.05
    distance_threshold: float = 0.1
    min_drifted_columns: int = 5
    zero_share: float = 1e-4
    ignore: tuple[str, ...] = ("index",)


def _per_feature(df: DataFrame, n_features: int | None) -> DataFrame:
    """A table of one row per feature, for a broadcast join where the caller knows how many
    columns it asked for; otherwise the planner decides."""
    return broadcast_known(df, n_features) if n_features is not None else df


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def long_counts_tagged(df: DataFrame, is_ref: Column, columns: Sequence[str], numeric: bool) -> DataFrame:
    """(feature, v, n_ref, n_cur) for the listed columns of one frame whose rows are tagged
    reference or current by ``is_ref`` (one scan; rows where it is null are left out)."""
    typ = "double" if numeric else "string"
    u = df.select(
        is_ref.cast("int").alias("__ref"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(typ).alias("v")) for c in columns])).alias("__s"),
    ).select("__ref", "__s.feature", "__s.v").filter(F.col("v").isNotNull() & F.col("__ref").isNotNull())
    return u.groupBy("feature", "v").agg(
        F.sum("__ref").cast("long").alias("n_ref"), F.sum(1 - F.col("__ref")).cast("long").alias("n_cur")
    )


def long_counts(ref: DataFrame, cur: DataFrame, columns: Sequence[str], numeric: bool) -> DataFrame:
    """(feature, v, n_ref, n_cur) for two separate frames (one scan of each)."""
    cols = list(columns)
    both = ref.select(*cols, F.lit(True).alias("__is_ref")).unionByName(cur.select(*cols, F.lit(False).alias("__is_ref")))
    return long_counts_tagged(both, F.col("__is_ref"), cols, numeric)


def _cdf(counts: DataFrame, n_features: int | None) -> DataFrame:
    cum = cumulative_counts(counts, "v", ["n_ref", "n_cur"], by=["feature"], n_groups=n_features)
    return cum.select(
        "feature", "v", "next_value",
        F.try_divide(F.col("cum_n_ref"), F.col("total_n_ref")).alias("f_ref"),
        F.try_divide(F.col("cum_n_cur"), F.col("total_n_cur")).alias("f_cur"),
        F.col("total_n_ref"), F.col("total_n_cur"),
    )


def ks_frame(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per numeric column."""
    return ks_from_counts(long_counts(ref, cur, columns, True), len(columns))


def ks_from_counts(counts: DataFrame, n_features: int | None = None) -> DataFrame:
    cdf = _cdf(counts, n_features)
    return cdf.groupBy("feature").agg(
        F.max(F.abs(F.col("f_ref") - F.col("f_cur"))).alias("ks_d"),
        F.first("total_n_ref").alias("n_ref"), F.first("total_n_cur").alias("n_cur"),
    )


def wasserstein_frame(ref: DataFrame, cur: DataFrame, columns: Sequence[str], min_norm: float = 0.001) -> DataFrame:
    """First Wasserstein distance per column, and the same divided by the reference std (population)."""
    return wasserstein_from_counts(long_counts(ref, cur, columns, True), min_norm, len(columns))


def wasserstein_from_counts(counts: DataFrame, min_norm: float = 0.001, n_features: int | None = None) -> DataFrame:
    cdf = _cdf(counts, n_features)
    dist = cdf.groupBy("feature").agg(
        F.when((F.max("total_n_ref") > 0) & (F.max("total_n_cur") > 0), F.coalesce(
            F.sum(F.abs(F.col("f_ref") - F.col("f_cur")) * (F.col("next_value") - F.col("v"))), F.lit(0.0))).alias("distance")
    )
    # Reference std in two stable passes over the count table (one row per column in between).
    means = counts.groupBy("feature").agg(F.try_divide(F.sum(F.col("v") * F.col("n_ref")), F.sum("n_ref")).alias("__mean"))
    var = counts.join(_per_feature(means, n_features), "feature").groupBy("feature").agg(
        F.sqrt(F.try_divide(F.sum(F.col("n_ref") * F.pow(F.col("v") - F.col("__mean"), 2)), F.sum("n_ref"))).alias("ref_std")
    )
    return dist.join(var, "feature", "left").select(
        "feature", "distance", "ref_std",
        (F.col("distance") / F.greatest(F.coalesce(F.col("ref_std"), F.lit(0.0)), F.lit(min_norm))).alias("normed"),
    )


def _shares(counts: DataFrame, zero_share: float, n_features: int | None) -> DataFrame:
    # Per-feature totals via a grouped aggregate joined back (bounded by the number of columns).
    tot = counts.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    j = counts.join(_per_feature(tot, n_features), "feature")
    p = F.try_divide(F.col("n_ref"), F.col("t_ref"))
    q = F.try_divide(F.col("n_cur"), F.col("t_cur"))
    return j.select(
        "feature", "v", "n_ref", "n_cur", "t_ref", "t_cur",
        F.when(p == 0, F.lit(zero_share)).otherwise(p).alias("p"),
        F.when(q == 0, F.lit(zero_share)).otherwise(q).alias("q"),
    )


def js_frame(ref: DataFrame, cur: DataFrame, columns: Sequence[str], zero_share: float = 1e-4) -> DataFrame:
    """Jensen-Shannon distance (natural log) of category shares, zero shares replaced by ``zero_share``."""
    return js_from_counts(long_counts(ref, cur, columns, False), zero_share, len(columns))


def js_from_counts(counts: DataFrame, zero_share: float = 1e-4, n_features: int | None = None) -> DataFrame:
    return _js_from_shares(_shares(counts, zero_share, n_features), n_features)


def _js_from_shares(s: DataFrame, n_features: int | None) -> DataFrame:
    norm = s.groupBy("feature").agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))
    j = s.join(_per_feature(norm, n_features), "feature")
    p = F.col("p") / F.col("sp")
    q = F.col("q") / F.col("sq")
    m = (p + q) / 2
    both = (F.sum(p * F.log(p / m)) + F.sum(q * F.log(q / m))) / 2
    return j.groupBy("feature").agg(F.when(both.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), both))).alias("js"))


def js_numeric_from_counts(counts: DataFrame, zero_share: float = 1e-4, n_features: int | None = None) -> DataFrame:
    rng = counts.groupBy("feature").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), (F.sum("n_ref") + F.sum("n_cur")).alias("n")
    ).withColumn("k", F.ceil(F.log2(F.col("n")) + 1).cast("int"))
    j = counts.join(_per_feature(rng, n_features), "feature")
    width = (F.col("hi") - F.col("lo")) / F.col("k")
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / width).cast("int"), F.col("k") - 1))
    binned = j.groupBy("feature", b.alias("bin"), "k").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    # empty bins count too (share 0 -> zero_share), so emit every bin of the grid
    grid = rng.select("feature", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("bin"))
    full = grid.join(binned.drop("k"), ["feature", "bin"], "left").select(
        "feature", F.col("bin").alias("v"), F.coalesce("n_ref", F.lit(0)).alias("n_ref"), F.coalesce("n_cur", F.lit(0)).alias("n_cur"))
    return _js_from_shares(_shares(full, zero_share, n_features), n_features)


def chi2_from_counts(counts: DataFrame, n_features: int | None = None, zero_share: float = 1e-4) -> DataFrame:
    tot = counts.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"), F.count(F.lit(1)).alias("k"))
    j = counts.join(_per_feature(tot, n_features), "feature")
    share = F.try_divide(F.col("n_ref"), F.col("t_ref"))
    exp = F.when(share == 0, F.lit(zero_share)).otherwise(share) * F.col("t_cur")
    return j.groupBy("feature").agg(
        F.sum(F.try_divide(F.pow(F.col("n_cur") - exp, 2), exp)).alias("chi2"), (F.first("k") - 1).alias("dof")
    )


def z_frame(ref: DataFrame, cur: DataFrame, columns: Sequence[str], numeric: bool = False) -> DataFrame:
    """Two-proportion z statistic for two-valued columns (share of the smallest value)."""
    return z_from_counts(long_counts(ref, cur, columns, numeric), len(columns))


def z_from_counts(counts: DataFrame, n_features: int | None = None) -> DataFrame:
    tot = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"), F.min("v").alias("label"))
    j = counts.join(_per_feature(tot, n_features), "feature").filter(F.col("v") == F.col("label"))
    p1 = F.try_divide(F.col("n_ref"), F.col("t_ref"))
    p2 = F.try_divide(F.col("n_cur"), F.col("t_cur"))
    pp = F.try_divide(F.col("n_ref") + F.col("n_cur"), F.col("t_ref") + F.col("t_cur"))
    spread = F.sqrt(pp * (1 - pp) * (F.try_divide(F.lit(1.0), F.col("t_ref")) + F.try_divide(F.lit(1.0), F.col("t_cur"))))
    return j.select("feature", F.when(spread == 0, F.lit(0.0)).otherwise((p1 - p2) / spread).alias("z"))


def drift_report(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None,
                 rules: DriftRules = DriftRules()) -> DataFrame:
    """One row per column: kind, test, score, threshold, drift flag."""
    cols = [c for c in (columns or ref.columns) if c not in rules.ignore and c in cur.columns]
    both = ref.select(*cols, F.lit(True).alias("__is_ref")).unionByName(cur.select(*cols, F.lit(False).alias("__is_ref")))
    return drift_report_tagged(both, F.col("__is_ref"), cols, rules)


def drift_report_tagged(df: DataFrame, is_ref: Column, columns: Sequence[str], rules: DriftRules = DriftRules()) -> DataFrame:
    """Report for one frame tagged reference/current by ``is_ref``: one scan builds the
    value-count table of every column; it is kept while the tests read it and released after."""
    cols = [c for c in columns if c not in rules.ignore]
    num = [c for c in cols if _is_numeric(df, c)]
    cat = [c for c in cols if c not in num]
    spark = df.sparkSession
    schema = "feature string, kind string, test string, score double, threshold double, drift boolean, status string"
    if not cols:
        return spark.createDataFrame([], schema)
    # One scan and one shuffle for every column: numeric values in a double slot,
    # categorical values in a text slot.
    slots = [F.struct(F.lit(c).alias("feature"),
                      (F.col(c).cast("double") if c in num else F.lit(None).cast("double")).alias("vn"),
                      (F.col(c).cast("string") if c in cat else F.lit(None).cast("string")).alias("vs"))
             for c in cols]
    u = (df.select(is_ref.cast("int").alias("__ref"), F.explode(F.array(*slots)).alias("__s"))
         .select("__ref", "__s.*")
         .filter(F.col("__ref").isNotNull() & (F.col("vn").isNotNull() | F.col("vs").isNotNull())))
    both = materialize(u.groupBy("feature", "vn", "vs").agg(
        F.sum("__ref").cast("long").alias("n_ref"), F.sum(1 - F.col("__ref")).cast("long").alias("n_cur")), "persist")
    num_counts = both.filter(F.col("vn").isNotNull()).select("feature", F.col("vn").alias("v"), "n_ref", "n_cur") if num else None
    cat_counts = both.filter(F.col("vs").isNotNull()).select("feature", F.col("vs").alias("v"), "n_ref", "n_cur") if cat else None
    try:
        stats = {}
        for c in (num_counts, cat_counts):
            if c is not None:
                for r in c.groupBy("feature").agg(F.count(F.lit(1)).alias("u"), F.sum("n_ref").alias("nr"), F.sum("n_cur").alias("nc")).collect():
                    stats[r["feature"]] = (r["u"], r["nr"], r["nc"])
        plan: dict[str, str] = {}
        out = []
        for c in cols:
            u, n_ref, n_cur = stats.get(c, (0, 0, 0))
            is_num = c in num
            if c in dict(rules.tests):
                plan[c] = dict(rules.tests)[c]
            elif rules.small_reference_rows is not None and n_ref <= rules.small_reference_rows:
                plan[c] = "ks" if (is_num and u > rules.few_values) else ("chisquare" if u > 2 else "z")
            else:
                plan[c] = "wasserstein" if (is_num and u > rules.few_values) else "jensenshannon"
            if not n_ref or not n_cur:
                status = "no_values" if n_ref == n_cur else "no_current_values" if n_ref else "no_reference_values"
                limit = rules.distance_threshold if plan[c] in ("wasserstein", "jensenshannon") else rules.p_threshold
                out.append((c, "num" if is_num else "cat", plan[c], None, limit, status != "no_values", status))
                del plan[c]

        for counts, kind in ((num_counts, "num"), (cat_counts, "cat")):
            if counts is None:
                continue
            own = num if kind == "num" else cat

            def sel(counts: DataFrame, test: str, own=own) -> tuple[DataFrame, int]:
                names = [c for c in own if plan.get(c) == test]
                return counts.filter(F.col("feature").isin(names)), len(names)

            sub, n_sel = sel(counts, "ks")
            if n_sel:
                for r in ks_from_counts(sub, n_sel).collect():
                    p = ks_2samp_pvalue(r["ks_d"], r["n_ref"], r["n_cur"])
                    out.append((r["feature"], kind, "ks", p, rules.p_threshold, p < rules.p_threshold, "ok"))
            sub, n_sel = sel(counts, "wasserstein")
            if n_sel:
                for r in wasserstein_from_counts(sub, n_features=n_sel).collect():
                    d = r["normed"]
                    out.append((r["feature"], kind, "wasserstein", d, rules.distance_threshold, d >= rules.distance_threshold, "ok"))
            sub, n_sel = sel(counts, "jensenshannon")
            if n_sel:
                frame = (js_numeric_from_counts(sub, rules.zero_share, n_sel) if kind == "num"
                         else js_from_counts(sub, rules.zero_share, n_sel))
                for r in frame.collect():
                    d = r["js"]
                    out.append((r["feature"], kind, "jensenshannon", d, rules.distance_threshold, d >= rules.distance_threshold, "ok"))
            sub, n_sel = sel(counts, "chisquare")
            if n_sel:
                for r in chi2_from_counts(sub, n_sel, rules.zero_share).collect():
                    p = chi2_sf(r["chi2"], r["dof"]) if r["chi2"] is not None else float("nan")
                    out.append((r["feature"], kind, "chisquare", p, rules.p_threshold, bool(p < rules.p_threshold), "ok"))
            sub, n_sel = sel(counts, "z")
            if n_sel:
                for r in z_from_counts(sub, n_sel).collect():
                    z = r["z"]
                    p = 2 * norm_sf(abs(z)) if z is not None and not math.isnan(z) else float("nan")
                    out.append((r["feature"], kind, "z", p, rules.p_threshold, bool(p < rules.p_threshold), "ok"))
    finally:
        both.unpersist()
    return spark.createDataFrame(sorted(out, key=lambda r: r[0]), schema)


def drift_decision(report: DataFrame, rules: DriftRules = DriftRules()) -> DataFrame:
    """Drift when at least ``min_drifted_columns`` columns are flagged."""
    return report.agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.coalesce(F.sum(F.col("drift").cast("int")), F.lit(0)).alias("n_drifted"),
    ).withColumn("drift", F.col("n_drifted") >= F.lit(rules.min_drifted_columns))


def drift_monitor(df: DataFrame, date_col: str, cut: str, start: str | None = None, min_rows: int = 1000,
                  rules: DriftRules = DriftRules(), columns: Sequence[str] | None = None) -> DataFrame:
    """Date split, row gate on the new rows, report and decision, as one row (no exit code).

    The split is a tag on one scan (reference: ``start <= d <= cut``; current: ``d > cut``)."""
    d = F.col(date_col)
    cut_d = F.lit(cut).cast("date")
    ref_cond = d <= cut_d if start is None else (d <= cut_d) & (d >= F.lit(start).cast("date"))
    is_ref = F.when(ref_cond, F.lit(True)).when(d > cut_d, F.lit(False))
    cols = [c for c in (columns or df.columns) if c != date_col]
    gate = df.filter(d > cut_d).count()
    spark = df.sparkSession
    schema = "n_cur long, gate boolean, n_columns long, n_drifted long, drift boolean"
    if gate < min_rows:
        return spark.createDataFrame([(gate, False, 0, 0, False)], schema)
    dec = drift_decision(drift_report_tagged(df, is_ref, cols, rules), rules).first()
    return spark.createDataFrame([(gate, True, dec["n_columns"], dec["n_drifted"], bool(dec["drift"]))], schema)
