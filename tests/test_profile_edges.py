"""Every profile operator on empty, one-row, two-row, constant, NaN, infinite and far-spread input; selection, bootstrap and density in depth."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from shelfspark.operators import profile as PR
from shelfspark.operators import ranks
from shelfspark.operators.selection import column_order_statistics, column_quantiles

NAN, INF = float("nan"), float("inf")
INPUTS = {
    "empty": [], "one": [3.0], "two": [1.0, 4.0], "constant": [2.0] * 5, "nulls": [None, None], "nan": [1.0, NAN, 2.0, 4.0, NAN],
    "infinite": [1.0, INF, 2.0, -INF, 4.0], "far": [1e300, -1e300, 5e-324, 0.0, -0.0, 1e308, -1e308], "gaps": [None, 1.0, None, 2.0],
}


@pytest.fixture(params=sorted(INPUTS))
def values(request):
    return INPUTS[request.param]


def frame(spark, values):
    return spark.createDataFrame([("a", None if v is None else float(v), 7) for v in values], "g string, x double, k int")


def fine(values):
    return [v for v in values if v is not None and math.isfinite(v)]


def test_all_operators_on_edges(spark, values):
    df = frame(spark, values)
    ok = fine(values)
    there = [v for v in values if v is not None and not math.isnan(v)]
    desc = {r["column"]: r for r in PR.describe_numeric(df).collect()}
    assert desc["x"]["count"] == len(there) and desc["k"]["count"] == len(values)
    if there and len(ok) == len(there):
        want = pd.Series(there).quantile([0.25, 0.5, 0.75]).tolist()
        assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-300) for a, b in zip([desc["x"][c] for c in ("p25", "p50", "p75")], want))
    elif not there:
        assert desc["x"]["p50"] is None
    skew = df.agg(PR.skewness_corrected("x")).first()[0]
    if len(ok) == len(there) and max(map(abs, ok), default=0) < 1e100:  # squares of larger ones overflow
        assert (skew is None) == (len(there) < 3 or len(set(there)) == 1)
    bins = PR.histogram(df, "x", 4).collect()
    assert sum(r["n"] for r in bins) == len(ok) if ok else bins == []
    assert all(math.isfinite(r["lower"]) for r in bins) or max(map(abs, ok)) > 1e300
    boxes = PR.box_stats(df, "g", "x").collect()
    assert len(boxes) == bool(ok)
    if ok and max(map(abs, ok)) < 1e300:
        assert boxes[0]["median"] == pytest.approx(pd.Series(ok).median()) and not math.isnan(boxes[0]["q3"])
        density = PR.density_grid(df, "x", 21).collect()
        assert len(density) == 21 and all(r["density"] >= 0 and math.isfinite(r["density"]) for r in density)
    means = PR.grouped_mean(df, "g", "x").collect()
    assert len(means) == bool(values)
    boot = PR.grouped_mean_bootstrap(df, "g", "x", ["k"], replicates=10).collect()
    assert len(boot) == bool(there)
    corr = PR.corr_matrix(df).collect()
    assert len(corr) == 4 and all(r["r"] == 1.0 for r in corr if r["a"] == r["b"])
    assert len(PR.null_profile(df).collect()) == 3 and len(PR.schema_profile(df).collect()) == 3
    assert len(PR.describe_categorical(df).collect()) == bool(values)
    assert len(PR.crosstab(df, "g", "k").collect()) == bool(values)


def test_no_numeric_column(spark):
    df = spark.createDataFrame([("a",)], "s string")
    assert PR.describe_numeric(df).collect() == [] and "p50" in PR.describe_numeric(df).columns


def test_density_is_symmetric_on_a_constant(spark):
    got = PR.density_grid(frame(spark, [5.0, 5.0, 5.0]), "x", 11).orderBy("i").collect()
    assert [r["x"] for r in got] == pytest.approx([5 + (i - 5) * 0.6 for i in range(11)])
    assert [r["density"] for r in got] == pytest.approx([r["density"] for r in reversed(got)])


@pytest.mark.parametrize("error", [1e-2, 1e-4])
def test_density_error_is_within_its_bound(spark, error):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=300), rng.exponential(4, 200), [60.0]])
    got = PR.density_grid(spark.createDataFrame([(float(v),) for v in x], "x double"), "x", 60, error=error).orderBy("i").collect()
    bw = x.std(ddof=1) * len(x) ** -0.2
    exact = [np.exp(-0.5 * ((r["x"] - x) / bw) ** 2).sum() / (len(x) * bw * math.sqrt(2 * math.pi)) for r in got]
    peak = 1 / (bw * math.sqrt(2 * math.pi))
    assert max(abs(r["density"] - e) for r, e in zip(got, exact)) <= error * peak
    assert got[0]["x"] == pytest.approx(x.min() - 3 * bw) and got[-1]["x"] == pytest.approx(x.max() + 3 * bw)


def test_bootstrap(spark):
    rng = random.Random(2)
    rows = [(i, "a" if i % 3 else "b", rng.gauss(10, 2)) for i in range(900)] + [(900, None, 1.0), (901, "a", None), (902, "a", NAN)]
    df = spark.createDataFrame(rows, "i int, g string, x double")
    one = {r["g"]: tuple(r) for r in PR.grouped_mean_bootstrap(df, "g", "x", ["i"], 200).collect()}
    two = {r["g"]: tuple(r) for r in PR.grouped_mean_bootstrap(df.repartition(7, "x"), "g", "x", ["i"], 200).collect()}
    assert one.keys() == two.keys() == {"a", "b", None}
    assert all(x == pytest.approx(y) for g in one for x, y in zip(one[g][1:], two[g][1:]))
    assert one["a"][1] == 600 and one[None][2] == one[None][3] == one[None][4] == 1.0
    normal = {r["g"]: r for r in PR.grouped_mean(df.filter("not isnan(x)"), "g", "x").collect()}
    for g in "ab":
        assert one[g][2] == pytest.approx(normal[g]["mean"])
        half = (normal[g]["ci_high"] - normal[g]["ci_low"]) / 2
        assert one[g][3] == pytest.approx(normal[g]["ci_low"], abs=0.35 * half) and one[g][4] == pytest.approx(normal[g]["ci_high"], abs=0.35 * half)
    assert PR.grouped_mean_bootstrap(df, "g", "x", ["i"], 200, seed=5).filter("g = 'a'").first()["ci_low"] != one["a"][3]


def test_poisson_weights(spark):
    """Weights have mean and variance 1 and the distribution's shares."""
    df = spark.range(40_000).selectExpr("md5(cast(id as string)) as h")
    w = [r[0] for r in df.select(PR.poisson_weight(df.h.substr(5, 4))).collect()]
    assert np.mean(w) == pytest.approx(1, abs=0.02) and np.var(w) == pytest.approx(1, abs=0.04)
    assert w.count(0) / len(w) == pytest.approx(math.exp(-1), abs=0.01) and w.count(2) / len(w) == pytest.approx(math.exp(-1) / 2, abs=0.01)


def spread(rng, kind, n):
    if kind == "even":
        return rng.uniform(-5, 5, n)
    if kind == "ties":
        return rng.integers(0, 7, n).astype(float)
    if kind == "wide":
        return np.exp(rng.normal(0, 60, n)) * rng.choice([-1, 1], n)
    if kind == "crowded low":
        return 1 + np.exp2(-rng.uniform(0, 52, n))
    if kind == "crowded high":
        return 4 - np.exp2(-rng.uniform(0, 51, n))
    return np.concatenate([np.full(n - 5, 3.0), [np.inf, np.inf, -np.inf, 1e308, -1e308]])


@pytest.mark.parametrize("few", [0, 50])
def test_selection_on_all_spreads(spark, monkeypatch, few):
    """Six columns at once, narrowed to single values (few = 0) or finished by counts."""
    from shelfspark.operators import selection

    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "PARTS", 64)
    rng = np.random.default_rng(9)
    kinds = ["even", "ties", "wide", "crowded low", "crowded high", "infinite"]
    data = np.column_stack([spread(rng, k, 1500) for k in kinds])
    names = [k.replace(" ", "_") for k in kinds]
    rows = [[None if rng.random() < 0.05 else float(v) for v in r] for r in data] + [[NAN] * 6]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    ranks_wanted = lambda n: [0, 1, n // 7, n // 2, n - 2, n - 1]
    got = column_order_statistics(df, names, ranks_wanted)
    for j, name in enumerate(names):
        column = sorted(r[j] for r in rows if r[j] is not None and not math.isnan(r[j]))
        n, at = got[name]
        assert n == len(column) and at == {k: column[k] for k in ranks_wanted(n)}


def test_selection_shuffles_no_rows(spark):
    """What a pass shuffles does not grow with the rows."""
    small, large = (spark.range(n).selectExpr("cast(hash(id) as double) as x", "cast(id as double) as y") for n in (4_000, 400_000))
    probs = [0.01, 0.25, 0.5, 0.75, 0.999]
    for df in (small, large):
        got = column_quantiles(df, ["x", "y"], probs)
        want = df.selectExpr(*[f"percentile({c}, array({', '.join(map(str, probs))})) as {c}" for c in ("x", "y")]).first()
        assert got["x"] == pytest.approx(want["x"], rel=1e-12) and got["y"] == pytest.approx(want["y"], rel=1e-12)


def test_quantiles_by_selection_and_buckets_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    probs = [i / 20 for i in range(21)]
    assert ranks.exact_quantiles(df, "l_extendedprice", probs) == pytest.approx(ranks.exact_quantiles(df, "l_extendedprice", probs, n_buckets=8))
