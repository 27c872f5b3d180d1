"""Rank tests and residual tables.

Statistics come from Spark aggregates over the value-count table of
``ranks.py``; only the final handful of sums reaches the driver, where the
p-value is computed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.distributions import chi2_sf, norm_ppf, norm_sf, signed_rank_tails, t_ppf
from shelfspark.operators.ranks import cumulative_counts, exact_quantiles
from shelfspark.session import materialize


def _tie_term() -> Column:
    n = F.col("n").cast("double")
    return F.sum(n * n * n - n)


def group_rank_sums(df: DataFrame, value: str, group: str, groups: Sequence | None = None,
                    n_buckets: int | None = None, hold: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Per group: size and rank sum; overall: N and the tie term sum(t^3 - t).

    Counts are kept per (value, group); the ranks are computed on the per-value
    table and joined back on the value (one row per distinct value each side).
    With ``hold`` (a list), the (value, group) count table is persisted, since both
    outputs read it, and appended to ``hold`` for the caller to release.
    """
    src = df.select(F.col(value).alias("v"), F.col(group).alias("g")).filter(F.col("v").isNotNull() & F.col("g").isNotNull())
    if groups is not None:
        src = src.filter(F.col("g").isin(list(groups)))
    vg = src.groupBy("v", "g").agg(F.count(F.lit(1)).alias("n_g"))
    if hold is not None:
        vg = materialize(vg, "persist")
        hold.append(vg)
    vc = vg.groupBy("v").agg(F.sum("n_g").alias("n"))
    cum = cumulative_counts(vc, "v", ["n"], (), n_buckets)
    ranked = cum.select("v", "n", (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0).alias("avg_rank"))
    overall = ranked.agg(F.sum("n").alias("N"), _tie_term().alias("ties"))
    per_group = vg.join(ranked.select("v", "avg_rank"), "v").groupBy("g").agg(
        F.sum("n_g").alias("n"), F.sum(F.col("n_g") * F.col("avg_rank")).alias("rank_sum")
    )
    return per_group, overall


def kruskal_wallis_frame(df: DataFrame, value: str, group: str, groups: Sequence | None = None) -> DataFrame:
    """One row: H (tie corrected), degrees of freedom, N and k.

    The per-group rank sums (one row per group) are kept while both driver reads run."""
    hold: list = []
    per_group, overall = group_rank_sums(df, value, group, groups, hold=hold)
    per_group = materialize(per_group, "persist")
    hold.append(per_group)
    try:
        g = per_group.agg(F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("s"),
                          F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"))
        gg = g.first()
        o = overall.first()
    finally:
        for h in hold:
            h.unpersist()
    N, ties = float(gg["N"] or 0), float(o["ties"] or 0)
    if N < 2 or gg["k"] < 2 or ties >= N ** 3 - N:  # too few values, or all of them tied
        h = None
    else:
        h = (12.0 / (N * (N + 1)) * gg["s"] - 3 * (N + 1)) / (1 - ties / (N ** 3 - N))
    spark = df.sparkSession
    return spark.createDataFrame([(h, int(gg["k"]) - 1, int(N), int(gg["k"]))], "h double, dof int, n long, k int")


@dataclass
class TestResult:
    statistic: float | None
    p_value: float | None
    n: int

    def as_dict(self) -> dict:
        return asdict(self)


def kruskal_wallis(df: DataFrame, value: str, group: str, groups: Sequence | None = None) -> TestResult:
    r = kruskal_wallis_frame(df, value, group, groups).first()
    p = chi2_sf(r["h"], r["dof"]) if r["h"] is not None else None
    return TestResult(r["h"], p, r["n"])


def mann_whitney_frame(df: DataFrame, value: str, group: str, first, second) -> DataFrame:
    """One row: U of the first group, n1, n2, tie term."""
    hold: list = []
    per_group, overall = group_rank_sums(df, value, group, [first, second], hold=hold)
    try:
        rows = {r["g"]: r for r in per_group.collect()}  # two rows
        o = overall.first()
    finally:
        for h in hold:
            h.unpersist()
    n1 = rows[first]["n"] if first in rows else 0
    n2 = rows[second]["n"] if second in rows else 0
    r1 = rows[first]["rank_sum"] if first in rows else 0.0
    u1 = r1 - n1 * (n1 + 1) / 2.0
    return df.sparkSession.createDataFrame([(float(u1), int(n1), int(n2), float(o["ties"] or 0))],
                                           "u double, n1 long, n2 long, ties double")


def mann_whitney(df: DataFrame, value: str, group: str, first, second, continuity: bool = True) -> TestResult:
    """Two-sided U test, normal approximation with tie correction."""
    r = mann_whitney_frame(df, value, group, first, second).first()
    n1, n2, u, ties = r["n1"], r["n2"], r["u"], r["ties"]
    N = n1 + n2
    if n1 == 0 or n2 == 0:
        return TestResult(u, None, N)
    mu = n1 * n2 / 2.0
    sigma = math.sqrt(max(0.0, n1 * n2 / 12.0 * ((N + 1) - ties / (N * (N - 1)))))
    if sigma == 0:  # every value tied: the groups do not differ
        return TestResult(u, 1.0, N)
    umax = max(u, n1 * n2 - u)
    z = (umax - mu - (0.5 if continuity else 0.0)) / sigma
    return TestResult(u, min(1.0, 2.0 * norm_sf(z)), N)


def _signed_ranks(df: DataFrame, a: str | Column, b: str | Column | None, n_buckets: int | None) -> DataFrame:
    """Per distinct ``abs(a - b)`` (zeros and nulls dropped): rows n, positive ones n_pos, and their average rank r."""
    ca = F.col(a) if isinstance(a, str) else a
    d = ca if b is None else ca - (F.col(b) if isinstance(b, str) else b)
    src = df.select(d.alias("d")).filter(F.col("d").isNotNull() & (F.col("d") != 0))
    vc = src.groupBy(F.abs("d").alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("d") > 0).cast("long")).alias("n_pos")
    )
    cum = cumulative_counts(vc, "v", ["n"], (), n_buckets)
    return cum.select("n", "n_pos", (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0).alias("r"))


def _rank_sums(ranked: DataFrame) -> DataFrame:
    return ranked.agg(
        F.sum(F.col("n_pos") * F.col("r")).alias("w_plus"),
        F.sum((F.col("n") - F.col("n_pos")) * F.col("r")).alias("w_minus"),
        F.sum("n").alias("n"),
        _tie_term().alias("ties"),
    )


def wilcoxon_frame(df: DataFrame, a: str | Column, b: str | Column | None = None, n_buckets: int | None = None) -> DataFrame:
    """Paired signed-rank sums of ``d = a - b`` (zeros dropped): W+, W-, n, tie term."""
    return _rank_sums(_signed_ranks(df, a, b, n_buckets))


MOST_EXACT_PAIRS = 1000


def wilcoxon_signed(df: DataFrame, a: str | Column, b: str | Column | None = None, method: str = "normal") -> TestResult:
    """Two-sided signed-rank test; the statistic is min(W+, W-).

    ``method``: "normal" is the normal approximation with tie correction, for any number of pairs. "exact" takes the
    null distribution of W+ over all signs of the observed ranks (ties keep their average ranks); the ranks, at most
    ``MOST_EXACT_PAIRS`` of them, come to the driver, and more pairs are an error. Which one is used is the
    caller's choice, never a matter of the size.
    """
    if method not in ("normal", "exact"):
        raise ValueError(f"unknown method {method!r}")
    ranked = _signed_ranks(df, a, b, None)
    if method == "exact":
        rows = ranked.limit(MOST_EXACT_PAIRS + 1).collect()
        n = sum(r["n"] for r in rows)
        if n > MOST_EXACT_PAIRS:
            raise ValueError(f"the exact test takes up to {MOST_EXACT_PAIRS} pairs that differ")
        if n == 0:
            return TestResult(None, None, 0)
        w_plus = sum(r["n_pos"] * r["r"] for r in rows)
        low, high = signed_rank_tails([r["r"] for r in rows for _ in range(r["n"])], w_plus)
        return TestResult(float(min(w_plus, n * (n + 1) / 2.0 - w_plus)), min(1.0, 2.0 * min(low, high)), n)
    r = _rank_sums(ranked).first()
    n = int(r["n"] or 0)
    if n == 0:
        return TestResult(None, None, 0)
    t = min(r["w_plus"], r["w_minus"])
    mean = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0 - (r["ties"] or 0) / 48.0
    z = (t - mean) / math.sqrt(var) if var > 0 else 0.0
    return TestResult(float(t), min(1.0, 2.0 * norm_sf(abs(z))), n)


@dataclass
class TFit:
    """A fitted location-scale t; converged is False if the last step still moved."""
    loc: float
    scale: float
    dof: float
    n: int
    steps: int
    converged: bool


MOST_DOF = 1e4  # beyond it a t is a normal for any purpose here


def fit_t(df: DataFrame, column: str, max_steps: int = 100, tol: float = 1e-7) -> TFit:
    """Maximum-likelihood location, scale and degrees of freedom of Student's t, by EM with one aggregate a step.

    A step sums the weights w = (v + 1) / (v + z^2) and w d, w d^2 of the deviations d from the present location, which
    gives the next location and scale (scale by the sum of weights: the parameter-expanded update), and the sums of
    ln(1 + z^2 / u) for five degrees of freedom u around the present ones; the likelihoods of the five and a parabola
    through the best three give the next. Nulls and non-finite values are left out. Only these sums reach the driver.
    """
    x = F.col(column).cast("double")
    rows = materialize(df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf"))), "persist")
    try:
        start = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", [0.25, 0.5, 0.75], 1000).alias("q"), F.stddev_samp("x").alias("sd")).first()
        n = start["n"]
        if n < 3 or not start["sd"]:
            raise ValueError("a t needs three values and some spread")
        loc = start["q"][1]
        scale, dof, ratio = ((start["q"][2] - start["q"][0]) / 1.4 or start["sd"]), 8.0, 2.0
        for step in range(1, max_steps + 1):
            tries = [min(dof * ratio ** k, 2 * MOST_DOF) for k in (-2, -1, 0, 1, 2)]
            d = F.col("x") - F.lit(loc)
            z2 = d * d / F.lit(scale * scale)
            w = F.lit(dof + 1.0) / (F.lit(dof) + z2)
            r = rows.agg(F.sum(w).alias("w"), F.sum(w * d).alias("wd"), F.sum(w * d * d).alias("wdd"),
                         *[F.sum(F.log1p(z2 / F.lit(u))).alias(f"l{k}") for k, u in enumerate(tries)]).first()
            like = [n * (math.lgamma((u + 1) / 2) - math.lgamma(u / 2) - 0.5 * math.log(u)) - (u + 1) / 2 * r[f"l{k}"] for k, u in enumerate(tries)]
            shift = r["wd"] / r["w"]
            spread = math.sqrt(max(r["wdd"] / r["w"] - shift * shift, 0.0))
            best = max(range(5), key=lambda k: like[k])
            if 0 < best < 4:
                left, mid, right = like[best - 1:best + 2]
                bend = left - 2 * mid + right
                new_dof = tries[best] * ratio ** (0.5 * (left - right) / bend if bend < 0 else 0.0)
                ratio = max(1.0 + 1e-4, math.sqrt(ratio))
            else:
                new_dof = tries[best]
            new_dof = min(max(new_dof, 0.05), MOST_DOF)
            moved = max(abs(shift) / scale, abs(spread - scale) / scale, abs(new_dof - dof) / dof)
            loc, scale, dof = loc + shift, spread, new_dof
            if moved < tol or scale == 0:
                return TFit(loc, scale, dof, n, step, moved < tol)
        return TFit(loc, scale, dof, n, max_steps, False)
    finally:
        rows.unpersist()


def qq_points(df: DataFrame, column: str, n_points: int = 100, distribution: str = "normal") -> DataFrame:
    """Sample quantiles at (i - 0.5) / m against theoretical ones.

    ``distribution``: "normal" gives standard-normal quantiles; "t" gives those of a Student's t fitted to the column
    (``fit_t``, location and scale applied), so points on the diagonal speak for it.
    """
    if distribution not in ("normal", "t"):
        raise ValueError(f"unknown distribution {distribution!r}")
    probs = [(i - 0.5) / n_points for i in range(1, n_points + 1)]
    sample = exact_quantiles(df, column, probs)
    if distribution == "normal":
        theory = [norm_ppf(p) for p in probs]
    else:
        fit = fit_t(df, column)
        theory = [fit.loc + fit.scale * t_ppf(p, fit.dof) for p in probs]
    rows = [(i, p, t, q) for i, (p, t, q) in enumerate(zip(probs, theory, sample), start=1)]
    return df.sparkSession.createDataFrame(rows, "i int, p double, theoretical double, sample double")


def residual_table(df: DataFrame, label: str, prediction: str | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Label, prediction and residual (prediction less label)."""
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    return df.select(*keep, F.col(label), pred.alias("prediction"), (pred - F.col(label)).alias("residual"))
