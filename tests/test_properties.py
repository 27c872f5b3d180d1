"""Property tests: brute-force agreement on random data, partition-count invariance."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfspark.operators import features as FE
from shelfspark.operators import ranks
from shelfspark.plans.retail import TESTDATA_PRESET as P
from shelfspark.plans.retail import feature_pipeline_fit
from shelfspark.sources.testdata import sales_view

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.integers(min_value=-20, max_value=20).map(float), min_size=1, max_size=60)


@SETTINGS
@given(vals=values, k=st.sampled_from([1, 3]))
def test_exact_quantiles_equal_numpy(spark, vals, k):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = ranks.exact_quantiles(df, "x", probs, n_buckets=k)
    assert got == pytest.approx(list(np.quantile(np.array(vals), probs)), abs=1e-9)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 4).map(float)), min_size=1, max_size=40))
def test_group_mode_equals_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, v double")
    got = {r["k"]: r["mode"] for r in FE.group_mode(df, "k", "v").collect()}
    want = {}
    for key in {p[0] for p in pairs}:
        c = Counter(v for k, v in pairs if k == key)
        top = max(c.values())
        want[key] = min(v for v, n in c.items() if n == top)
    assert got == want


def test_feature_fit_ignores_partitioning(spark):
    d = "/root/testdata/sf0.001"
    s = sales_view(spark, d)
    f1, p1 = feature_pipeline_fit(s.repartition(1), P, materialize_as="none")
    f2, p2 = feature_pipeline_fit(s.repartition(7), P, materialize_as="none")
    assert p1.cuts == p2.cuts
    assert sorted(map(tuple, p1.modes.collect())) == sorted(map(tuple, p2.modes.collect()))
    assert sorted(map(tuple, f1.collect())) == sorted(map(tuple, f2.collect()))


def test_bins_partition_rows(spark):
    """Every row with a price lands in exactly one of the four bins, in cut order."""
    s = sales_view(spark, "/root/testdata/sf0.001")
    cuts = FE.quantile_bin_fit(s, "Item_MRP")
    binned = FE.quantile_bin_apply(s, "Item_MRP", cuts, out="b").select("Item_MRP", "b").collect()
    assert {r["b"] for r in binned} == {1, 2, 3, 4}
    for r in binned:
        lo = cuts[r["b"] - 1] if r["b"] > 1 else float("-inf")
        assert lo < r["Item_MRP"] <= (cuts[r["b"]] if r["b"] < 4 else float("inf"))


@pytest.mark.parametrize("cols", [["l_orderkey", "Item_Fat_Content"], ["Outlet_Type", "Item_Outlet_Sales"],
                                  ["Item_Weight", "date_created"], ["Outlet_Location_Type", "Item_MRP"]])
def test_pruned_view_equals_full_view(spark, cols):
    d = "/root/testdata/sf0.001"
    full = sales_view(spark, d).select(*cols)
    pruned = sales_view(spark, d, cols)
    assert pruned.columns == cols
    assert full.exceptAll(pruned).count() == 0 and pruned.exceptAll(full).count() == 0
