"""Fixtures of the reference's own tests, rank statistics on textbook cases, split properties."""

import math
import random

import numpy as np
import pytest

from shelfspark.functions.distributions import chi2_sf, norm_sf
from shelfspark.operators import model as M
from shelfspark.operators import stats as ST


def test_linear_fit_y_equals_x_plus_500(spark):
    train = spark.createDataFrame([(float(x), float(x + 500)) for x in range(500)], "x double, y double")
    val = spark.createDataFrame([(float(x), float(x + 500)) for x in range(100)], "x double, y double")
    m = M.fit_linear(train, ["x"], "y")
    assert m.coefficients[0] == pytest.approx(1.0) and m.intercept == pytest.approx(500.0)
    r = M.regression_metrics(val, "y", m.predict_expr()).first()
    assert r["rmse"] == pytest.approx(0.0, abs=1e-6) and r["r2"] == pytest.approx(1.0)
    s = M.fit_simple_linear(train, "x", "y").first()
    assert (s["slope"], s["intercept"]) == pytest.approx((1.0, 500.0))


def test_mann_whitney_textbook(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "x"), (3.0, "x"), (4.0, "y"), (5.0, "y"), (6.0, "y")], "v double, g string")
    r = ST.mann_whitney(df, "v", "g", "x", "y")
    assert r.statistic == 0.0
    # normal approximation with continuity: z = (9 - 4.5 - 0.5) / sqrt(9*7/12)
    assert r.p_value == pytest.approx(2 * norm_sf(4.0 / math.sqrt(63 / 12)))


def test_kruskal_wallis_with_ties(spark):
    data = {"a": [1, 2, 2, 3], "b": [2, 4, 5], "c": [6, 6, 7]}
    df = spark.createDataFrame([(float(v), g) for g, vs in data.items() for v in vs], "v double, g string")
    allv = sorted(float(v) for vs in data.values() for v in vs)
    rank = {v: (allv.index(v) + 1 + allv.index(v) + allv.count(v)) / 2 for v in allv}
    n = len(allv)
    h = 12 / (n * (n + 1)) * sum(sum(rank[float(v)] for v in vs) ** 2 / len(vs) for vs in data.values()) - 3 * (n + 1)
    ties = sum(allv.count(v) ** 3 - allv.count(v) for v in set(allv))
    h /= 1 - ties / (n ** 3 - n)
    r = ST.kruskal_wallis(df, "v", "g")
    assert r.statistic == pytest.approx(h)
    assert r.p_value == pytest.approx(chi2_sf(h, 2))


def test_chi2_sf_known_values():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, rel=1e-9)


def test_wilcoxon_drops_zeros_and_averages_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0), (1.0, 3.0), (5.0, 1.0), (2.0, 1.0)], "a double, b double")
    w = ST.wilcoxon_frame(df, "a", "b").first()
    # d = 0 (dropped), 2, -2, 4, 1 -> |d| ranks: 1 -> 1, 2 -> 2.5 (tie), 4 -> 4
    assert (w["w_plus"], w["w_minus"], w["n"]) == (7.5, 2.5, 4)


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = M.train_val_split_tag(df.repartition(3), ["k"], 28, 0.7)
    b = M.train_val_split_tag(df.repartition(11), ["k"], 28, 0.7)
    ja = {r["k"]: r["split"] for r in a.collect()}
    assert ja == {r["k"]: r["split"] for r in b.collect()}
    share = sum(1 for v in ja.values() if v == "train") / len(ja)
    assert 0.67 < share < 0.73
    tr, va = M.train_val_split(df, ["k"], 28, 0.7, exact_size=True)
    assert tr.count() == 3500 and va.count() == 1500
    assert tr.join(va, "k").count() == 0


def test_scored_rows_are_linear(spark):
    """A linear score over features with dummies that sum to one is fitted exactly."""
    rnd = random.Random(28)
    rows = []
    for _ in range(400):
        mrp, kind = rnd.randint(1, 4), rnd.randrange(4)
        rows.append((float(mrp), rnd.uniform(4, 21), *[int(kind == k) for k in range(4)], 825.0 * mrp + 300.0 * kind - 12.5))
    df = spark.createDataFrame(rows, "mrp double, weight double, t0 int, t1 int, t2 int, t3 int, score double")
    m = M.fit_linear(df, df.columns[:-1], "score")
    r = M.regression_metrics(df, "score", m.predict_expr()).first()
    assert r["n"] == 400 and r["r2"] == pytest.approx(1.0, abs=1e-9)
    assert m.coefficients[0] == pytest.approx(825.0) and m.coefficients[1] == pytest.approx(0.0, abs=1e-6)


def test_fit_far_from_zero(spark):
    df = spark.createDataFrame([(1e9 + i, 2 * (1e9 + i) + 7.0) for i in range(10)], "x double, y double")
    m = M.fit_linear(df, ["x"], "y")
    assert m.coefficients[0] == pytest.approx(2.0, abs=1e-9) and m.intercept == pytest.approx(7.0, abs=1e-3)


def test_constant_label_and_tied_groups(spark):
    df = spark.createDataFrame([(5.0, 4.0, "a"), (5.0, 6.0, "b")], "y double, p double, g string")
    r = M.regression_metrics(df, "y", "p").first()
    assert r["mse"] == 1.0 and r["r2"] is None
    assert ST.kruskal_wallis(df, "y", "g").statistic is None
    assert ST.mann_whitney(df, "y", "g", "a", "b").p_value == 1.0
    assert [r["residual"] for r in ST.residual_table(df, "y", "p").collect()] == [-1.0, 1.0]


def test_fit_linear_matches_numpy_with_collinear_dummies(spark):
    import numpy as np

    rnd = np.random.default_rng(5)
    n = 400
    x1 = rnd.normal(50, 10, n)
    g = rnd.integers(0, 3, n)
    d = [(g == i).astype(float) for i in range(3)]  # the dummies sum to one: collinear with the intercept
    y = 3.0 * x1 + 40.0 * d[1] - 25.0 * d[2] + 7.0 + rnd.normal(0, 1, n)
    rows = [(float(a), float(b), float(c), float(e), float(t)) for a, b, c, e, t in zip(x1, *d, y)]
    rows.append((None, 1.0, 0.0, 0.0, 5.0))  # a null feature: left out of the fit
    df = spark.createDataFrame(rows, "x1 double, d0 double, d1 double, d2 double, y double").repartition(4)
    m = M.fit_linear(df, ["x1", "d0", "d1", "d2"], "y")
    X = np.column_stack([np.ones(n), x1, *d])
    coef = np.linalg.lstsq(X, y, rcond=None)[0]
    assert m.coefficients[0] == pytest.approx(coef[1], rel=1e-9)
    got = m.intercept + np.column_stack([x1, *d]) @ np.array(m.coefficients)
    assert np.allclose(got, X @ coef, rtol=1e-9, atol=1e-7)


def test_gram_of_many_columns_matches_numpy(spark):
    """60 columns (1,830 products) go through the blocks; some lie far from zero."""
    from pyspark.sql import functions as F

    from shelfspark.operators.gram import cross_sums, gram

    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 60)) + np.linspace(0, 1e8, 60)
    names = [f"c{i}" for i in range(60)]
    df = spark.createDataFrame(x.tolist(), names)
    g = gram(df, names)
    d = x - x.mean(axis=0)
    assert np.allclose(g.means, x.mean(axis=0)) and np.allclose(g.sums, d.T @ d, rtol=1e-6, atol=1e-6)
    few = gram(df, names[:5])
    assert np.allclose(few.sums, g.sums[:5, :5], rtol=1e-9)
    other = cross_sums(df, [F.col(n) for n in names[:10]], [F.col(n) for n in names[10:23]])
    assert np.allclose(other, x[:, :10].T @ x[:, 10:23], rtol=1e-9)
    m = M.fit_linear(df, names[:59], "c59")
    want = np.linalg.lstsq(d[:, :59], d[:, 59], rcond=None)[0]
    assert np.allclose(m.coefficients, want, atol=1e-5)


def test_several_models_of_one_gram(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=300)
    df = spark.createDataFrame(np.column_stack([x, y]).tolist(), ["a", "b", "c", "y"])
    from shelfspark.operators.gram import gram

    g = gram(df, ["a", "b", "c", "y"])
    for feats in (["a", "b", "c"], ["b"], ["c", "a"]):
        assert np.allclose(M.fit_from_gram(g, feats, "y").coefficients, M.fit_linear(df, feats, "y").coefficients, atol=1e-9)


def test_correlations_with_gaps_match_pandas(spark):
    import pandas as pd

    from shelfspark.operators import profile as PR

    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 14)) + 1e6
    x[:, 1] += 3 * x[:, 0]
    gaps = rng.random(x.shape) < 0.2
    rows = [[None if g else float(v) for v, g in zip(r, gs)] for r, gs in zip(x, gaps)]
    names = [f"c{i}" for i in range(14)]
    for frame in (rows, x.tolist()):
        df = spark.createDataFrame([[*r, 5.0] for r in frame], ", ".join(f"{n} double" for n in [*names, "flat"]))
        got = {(r["a"], r["b"]): r["r"] for r in PR.corr_matrix(df).collect()}
        want = pd.DataFrame(frame, columns=names).astype(float).corr()
        assert all(abs(got[a, b] - want.loc[a, b]) < 1e-8 for a in names for b in names)
        assert got["flat", "flat"] == 1.0 and got["flat", "c0"] is None


def test_simple_model_of_a_constant_feature(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 4.0)], "x double, y double")
    m = M.simple_model(df, "x", "y")
    assert m.coefficients == [0.0] and m.intercept == 2.5
    with pytest.raises(ValueError):
        M.simple_model(df.filter("x > 5"), "x", "y")


def brute_signed_rank(d):
    """Two-sided p over all signs of the ranks of |d|."""
    d = [x for x in d if x]
    size = sorted(abs(x) for x in d)
    ranks = [size.index(abs(x)) + (size.count(abs(x)) + 1) / 2 for x in d]
    w = sum(r for r, x in zip(ranks, d) if x > 0)
    sums = [sum(r for k, r in enumerate(ranks) if s >> k & 1) for s in range(1 << len(d))]
    return min(1.0, 2 * min(sum(x <= w for x in sums), sum(x >= w for x in sums)) / len(sums))


@pytest.mark.parametrize("d", [[1.0, 2, 3, 4, 5], [1.0, -2, 3, 3, -3, 0], [2.0], [-1.0, -1, -1, 1], [0.5 * i * (-1) ** (i // 3) for i in range(1, 13)],
                               [1.0, 1, 2, 2, -2, 7, -9, 9, 4, 0.5, -4]])
def test_exact_signed_rank(spark, d):
    df = spark.createDataFrame([(float(x), 0.0) for x in d], "a double, b double")
    r = ST.wilcoxon_signed(df, "a", "b", method="exact")
    assert abs(r.p_value - brute_signed_rank(d)) < 1e-12 and r.n == sum(x != 0 for x in d)
    assert r.statistic == ST.wilcoxon_signed(df, "a", "b").statistic


def test_exact_signed_rank_known_values_and_limits(spark):
    df = spark.createDataFrame([(float(x), 0.0) for x in range(1, 6)], "a double, b double")
    assert ST.wilcoxon_signed(df, "a", "b", method="exact").p_value == 0.0625
    assert ST.wilcoxon_signed(df.filter("a > 9"), "a", "b", method="exact").p_value is None
    many = spark.range(1500).selectExpr("cast(id + 1 as double) as a", "0.0 as b")
    with pytest.raises(ValueError):
        ST.wilcoxon_signed(many, "a", "b", method="exact")
    with pytest.raises(ValueError):
        ST.wilcoxon_signed(df, "a", "b", method="auto")
    rng = random.Random(1)
    some = spark.createDataFrame([(rng.gauss(0.2, 1), 0.0) for _ in range(400)], "a double, b double")
    exact, normal = (ST.wilcoxon_signed(some, "a", "b", method=m).p_value for m in ("exact", "normal"))
    assert abs(exact - normal) < 0.01 * exact + 1e-4


def test_compare_models_passes_the_choice_through(spark):
    df = spark.createDataFrame([(float(i), float(i) + 0.01 * i, float(i) - 0.5 - 0.1 * i) for i in range(1, 6)], "y double, new double, old double")
    exact, normal = (M.compare_models(df, "y", "new", "old", method=m) for m in ("exact", "normal"))
    assert exact.wilcoxon.p_value == 0.0625 and not exact.accept
    assert normal.wilcoxon.p_value < 0.05 and normal.accept


def test_t_quantiles():
    from shelfspark.functions.distributions import t_ppf, t_sf

    for p, dof, want in [(0.975, 5, 2.570581836), (0.975, 10, 2.228138852), (0.95, 3, 2.353363435), (0.75, 1, 1.0), (0.995, 30, 2.749995654)]:
        assert abs(t_ppf(p, dof) - want) < 1e-8 and abs(t_ppf(1 - p, dof) + want) < 1e-8
        assert abs(t_sf(want, dof) - (1 - p)) < 1e-9
    assert abs(t_ppf(0.9, 1e6) - 1.2815515655) < 1e-5 and t_ppf(0.5, 2) == 0


@pytest.mark.parametrize("loc, scale, dof", [(3.0, 2.0, 4.0), (-1e4, 50.0, 2.5), (0.0, 1e-3, 12.0)])
def test_t_fit_recovers_planted_parameters(spark, loc, scale, dof):
    from shelfspark.functions.distributions import t_ppf

    n = 4001  # the distribution's own quantiles: no sampling error
    values = [(loc + scale * t_ppf((i + 0.5) / n, dof),) for i in range(n)] + [(None,), (float("nan"),), (float("inf"),)]
    fit = ST.fit_t(spark.createDataFrame(values, "x double"), "x")
    assert fit.converged and fit.n == n
    assert abs(fit.loc - loc) < 1e-3 * scale and abs(fit.scale / scale - 1) < 0.01 and abs(fit.dof / dof - 1) < 0.08


def test_t_points_lie_on_the_diagonal(spark):
    from shelfspark.functions.distributions import t_ppf

    df = spark.createDataFrame([(5 + 2 * t_ppf((i + 0.5) / 999, 3.0),) for i in range(999)], "x double")
    got = ST.qq_points(df, "x", 20, distribution="t").collect()
    assert max(abs(r["theoretical"] - r["sample"]) for r in got) < 0.15
    normal = ST.qq_points(df, "x", 20).collect()
    assert [r["sample"] for r in normal] == [r["sample"] for r in got] and abs(normal[0]["theoretical"] + 1.959964) < 1e-5
    with pytest.raises(ValueError):
        ST.fit_t(spark.createDataFrame([(1.0,), (1.0,), (1.0,)], "x double"), "x")
