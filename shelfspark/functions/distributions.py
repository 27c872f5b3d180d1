"""Tail probabilities for p-values, computed on the driver from a few sums.

SciPy is not available; these are the textbook series / continued fractions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

_N = NormalDist()


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    return _N.inv_cdf(p)


def _gamma_p_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    n = a
    for _ in range(10_000):
        n += 1.0
        term *= x / n
        total += term
        if abs(term) < abs(total) * 1e-15:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_q_cf(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gamma_q(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gamma_p_series(a, x)
    return _gamma_q_cf(a, x)


def chi2_sf(x: float, dof: float) -> float:
    if x is None or dof <= 0 or math.isnan(x):
        return float("nan")
    return gamma_q(dof / 2.0, x / 2.0)


def kolmogorov_sf(lam: float) -> float:
    """P(K > lam) for the limiting Kolmogorov distribution."""
    if lam <= 0:
        return 1.0
    if lam < 0.2:
        return 1.0
    s = 0.0
    for k in range(1, 200):
        term = 2.0 * (-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam)
        s += term
        if abs(term) < 1e-16:
            break
    return min(1.0, max(0.0, s))


def ks_2samp_pvalue(d: float, n1: int, n2: int) -> float:
    """Asymptotic two-sided p-value with the small-sample correction of Stephens."""
    en = math.sqrt(n1 * n2 / (n1 + n2))
    return kolmogorov_sf((en + 0.12 + 0.11 / en) * d)


def signed_rank_tails(ranks: Sequence[float], w: float) -> tuple[float, float]:
    """P(W <= w) and P(W >= w) of the sum W of those of the given ranks that a fair coin makes positive.

    The null distribution of the signed-rank sum, conditional on ties: ranks are whole or half numbers, so doubled ranks
    are places of a table of probabilities that each rank in turn mixes with a copy of itself, moved by the rank.
    """
    import numpy as np

    doubled = [round(2 * r) for r in ranks]
    prob = np.zeros(sum(doubled) + 1)
    prob[0] = 1.0
    top = 0
    for r in doubled:
        moved = prob[:top + 1] / 2
        prob[:top + 1] = moved
        prob[r:r + top + 1] += moved
        top += r
    at = round(2 * w)
    return float(prob[:at + 1].sum()), float(prob[at:].sum())


def _beta_cf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return out


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1 - x) / b


def t_sf(t: float, dof: float) -> float:
    """P(T > t) of Student's t."""
    tail = 0.5 * beta_inc(dof / 2, 0.5, dof / (dof + t * t))
    return tail if t >= 0 else 1.0 - tail


def t_ppf(p: float, dof: float) -> float:
    """Quantile of Student's t: the tail is halved until it is bracketed, then bisected."""
    if p == 0.5:
        return 0.0
    tail = min(p, 1 - p)
    low, high = 0.0, 1.0
    while t_sf(high, dof) > tail:
        low, high = high, 2 * high
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if t_sf(mid, dof) > tail else (low, mid)
        if high - low <= 1e-15 * high:
            break
    return math.copysign((low + high) / 2, p - 0.5)
