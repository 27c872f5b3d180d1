"""Edge cases of modes, bins and encoders on hand-made frames."""

import pytest

from shelfspark.operators import features as FE
from shelfspark.plans.retail import SALES_RECORD_PRESET as REF
from shelfspark.plans.retail import feature_pipeline_apply, feature_pipeline_fit


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 1.0), ("a", 2.0), ("a", 1.0), ("b", 5.0), ("b", None)], "k string, v double")
    got = {r["k"]: r["mode"] for r in FE.group_mode(df, "k", "v").collect()}
    assert got == {"a": 1.0, "b": 5.0}


def test_mode_impute_fit_and_apply(spark):
    train = spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), ("a", None), ("b", None), ("c", 3.0), ("c", 3.0), ("c", 4.0)], "k string, v double")
    filled, imp = FE.mode_impute_fit(train, "k", "v")
    # key without values gets 0 on train, and the global mode in the table
    assert sorted((r["k"], r["v"]) for r in filled.collect()) == sorted(
        [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 0.0), ("c", 3.0), ("c", 3.0), ("c", 4.0)])
    assert imp.global_mode == 1.0  # 1.0 and 3.0 tie at two each: smallest wins
    assert {r["k"]: r["mode"] for r in imp.table.collect()} == {"a": 1.0, "b": 1.0}
    test = spark.createDataFrame([("a", None), ("c", None), ("z", None), ("z", 9.0), ("z", 9.0)], "k string, v double")
    got = sorted((r["k"], r["v"]) for r in imp.apply(test).collect())
    # c had no gap in train -> not in the table -> mode of the frame being filled (9.0)
    assert got == sorted([("a", 1.0), ("c", 9.0), ("z", 9.0), ("z", 9.0), ("z", 9.0)])
    assert sorted(r["v"] for r in imp.apply(test, fallback=-1.0).collect()) == [-1.0, -1.0, 1.0, 9.0, 9.0]


def test_mode_impute_overwrite(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", None), ("b", 5.0)], "k string, v double")
    got = sorted((r["k"], r["v"]) for r in FE.mode_impute_overwrite(df, "k", "v").collect())
    assert got == [("a", 2.0), ("a", 2.0), ("a", 2.0), ("a", 2.0), ("b", 5.0)]


def test_bins_edges_range_and_null(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 10)] + [(None,)], "p double")
    cuts = FE.quantile_bin_fit(df, "p")
    assert cuts == [1.0, 3.0, 5.0, 7.0, 9.0]
    test = spark.createDataFrame([(0.0,), (1.0,), (3.0,), (3.0001,), (7.0,), (9.0,), (100.0,), (None,)], "p double")
    got = [r["p"] for r in FE.quantile_bin_apply(test, "p", cuts).collect()]
    assert got == [1, 1, 1, 2, 3, 4, 4, None]


def test_equal_edges_raise(spark):
    df = spark.createDataFrame([(1.0,)] * 10 + [(2.0,)], "p double")
    with pytest.raises(FE.EqualEdgesError):
        FE.quantile_bin_fit(df, "p")


def test_ordinal_unknown_is_null_and_one_hot_names(spark):
    df = spark.createDataFrame([("High",), ("Small",), ("Huge",), (None,)], "s string")
    assert [r["s"] for r in FE.ordinal_encode(df, "s", REF.size_codes).collect()] == [2, 0, None, None]
    oh = FE.one_hot_fixed(spark.createDataFrame([("Supermarket Type1",), (None,)], "t string"), "t", list(REF.outlet_types))
    assert oh.columns == ["t_Grocery_Store", "t_Supermarket_Type1", "t_Supermarket_Type2", "t_Supermarket_Type3"]
    assert [tuple(r) for r in oh.collect()] == [(0, 1, 0, 0), (0, 0, 0, 0)]


def _records(spark):
    rows = [
        ("FDA15", 9.3, "Low Fat", 0.016, "Dairy", 249.8, "OUT049", 1999, "Medium", "Tier 1", "Supermarket Type1", 3735.1),
        ("DRC01", 5.92, "Regular", 0.019, "Soft Drinks", 48.3, "OUT018", 2009, "Medium", "Tier 3", "Supermarket Type2", 443.4),
        ("FDN15", 17.5, "low fat", 0.017, "Meat", 141.6, "OUT049", 1999, "Medium", "Tier 1", "Supermarket Type1", 2097.3),
        ("FDX07", None, "Regular", 0.0, "Fruits and Vegetables", 182.1, "OUT010", 1998, None, "Tier 3", "Grocery Store", 732.4),
        ("NCD19", 8.93, "LF", 0.0, "Household", 53.9, "OUT013", 1987, "High", "Tier 3", "Supermarket Type1", 994.7),
        ("FDA15", None, "reg", 0.05, "Dairy", 120.0, "OUT027", 1985, "Medium", "Tier 3", "Supermarket Type3", 4022.8),
        ("FDP36", 10.4, "Regular", 0.01, "Baking Goods", 51.4, "OUT018", 2009, "Medium", "Tier 3", "Supermarket Type2", 556.6),
        ("FDO10", 13.65, "Regular", 0.013, "Snack Foods", 57.7, "OUT013", 1987, "High", "Tier 3", "Supermarket Type1", 343.6),
    ]
    schema = ("Item_Identifier string, Item_Weight double, Item_Fat_Content string, Item_Visibility double, "
              "Item_Type string, Item_MRP double, Outlet_Identifier string, Outlet_Establishment_Year int, "
              "Outlet_Size string, Outlet_Location_Type string, Outlet_Type string, Item_Outlet_Sales double")
    return spark.createDataFrame(rows, schema)


def test_sales_record_chain(spark):
    df = _records(spark)
    feats, params = feature_pipeline_fit(df, REF)
    assert feats.columns == ["Item_Weight", "Item_Visibility", "Item_MRP", "Outlet_Establishment_Year", "Outlet_Size",
                             "Outlet_Location_Type", "Item_Outlet_Sales", "Outlet_Type_Grocery_Store",
                             "Outlet_Type_Supermarket_Type1", "Outlet_Type_Supermarket_Type2", "Outlet_Type_Supermarket_Type3"]
    rows = feats.collect()
    assert rows[0]["Outlet_Establishment_Year"] == 21 and rows[0]["Outlet_Size"] == 1 and rows[0]["Outlet_Location_Type"] == 2
    assert rows[3]["Outlet_Size"] == 0  # OUT010 is a listed outlet -> Small
    assert rows[3]["Item_Weight"] == 0.0  # FDX07 has no weight at all -> 0 on train
    assert rows[5]["Item_Weight"] == 9.3  # FDA15 filled with its mode
    assert sorted(r["Item_MRP"] for r in rows) == [1, 1, 2, 2, 3, 3, 4, 4]
    # fit then apply on the same rows gives the same features (except the no-value key's fallback)
    applied = feature_pipeline_apply(df, REF, params).collect()
    assert [r["Item_MRP"] for r in applied] == [r["Item_MRP"] for r in rows]
    assert applied[5]["Item_Weight"] == 9.3


def test_release_and_rounded_cuts(spark):
    df = _records(spark)
    feats, params = feature_pipeline_fit(df, REF)
    assert len(params.held) == 2
    exact = [r["Item_MRP"] for r in feature_pipeline_apply(df, REF, params).collect()]
    rounded = [r["Item_MRP"] for r in feature_pipeline_apply(df, REF, params, round_cuts=3).collect()]
    assert len(exact) == len(rounded) == 8
    params.release()
    assert params.held == []
    assert feats.count() == 8  # still computable after release


def test_histogram_has_every_bin_and_latest_takes_one_row(spark):
    from shelfspark.operators import profile as PR

    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    assert [r["n"] for r in PR.histogram(df, "x", 10).orderBy("bin").collect()] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    rows = [("k", 1, "a", 10), ("k", 1, "b", None), ("k", 0, "z", 99), ("s", 3, "c", 5)]
    for order in (rows, rows[::-1]):
        v = spark.createDataFrame(order, "key string, ts int, name string, n int")
        got = {r["key"]: (r["name"], r["n"]) for r in PR.latest_per_key(v, ["key"], "ts", ["name", "n"]).collect()}
        assert got == {"k": ("b", None), "s": ("c", 5)}
        assert PR.latest_per_key(v, ["key"], "ts", "name", "name", "nothing").count() == 0
    assert PR.row_gate(df, 2) == (True, 3)


def test_box_stats_keeps_the_null_group(spark):
    from shelfspark.operators import profile as PR

    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0)], "g string, x double")
    assert {r["g"]: r["median"] for r in PR.box_stats(df, "g", "x").collect()} == {"a": 1.0, None: 3.0}


def test_column_concat_keeps_keys_of_either_side(spark):
    from shelfspark.operators import transform as X

    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string"), spark.createDataFrame([(2, 5), (3, 6)], "k int, b int")
    assert sorted(map(tuple, X.column_concat(a, b, "k").collect())) == [(1, "x", None), (2, "y", 5), (3, None, 6)]


def test_no_local_checkpoint_folder_on_a_cluster():
    from types import SimpleNamespace

    from shelfspark.session import checkpoint_dir

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="shared"):
        checkpoint_dir(session)


def test_sparse_one_hot_means_the_same_as_the_wide_one(spark):
    from shelfspark.operators import features as FE

    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a"), (3, "c"), (4, "b")], "i int, x string")
    wide, labels = FE.one_hot_inferred(df, "x")
    index = FE.label_index(df, "x")
    assert sorted((r["label"], r["index"]) for r in index.collect()) == [(x, k) for k, x in enumerate(labels)]
    sparse = {r["i"]: r["x_ones"] for r in FE.one_hot_sparse(df, "x").collect()}
    for r in wide.collect():
        assert [r[f"x_{x}"] for x in labels] == [int(k in sparse[r["i"]]) for k in range(len(labels))]
    later = spark.createDataFrame([(9, "z"), (8, "c")], "i int, x string")
    assert {r["i"]: r["x_ones"] for r in FE.one_hot_sparse(later, "x", index).collect()} == {9: [], 8: [2]}
    assert FE.label_index(df.filter("i > 50"), "x").count() == 0


def test_label_index_of_100_000_labels(spark):
    """More labels than any list on the driver should hold, one of them on a third of all rows."""
    from pyspark.sql import functions as F

    from shelfspark.operators import features as FE

    df = spark.range(150_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("label"), F.col("id"))).alias("x"))
    got = FE.label_index(df, "x")
    r = got.agg(F.count("*").alias("n"), F.min("index").alias("lo"), F.max("index").alias("hi"), F.countDistinct("index").alias("d")).first()
    assert tuple(r) == (100_001, 0, 100_000, 100_001)
    near = got.alias("a").join(got.alias("b"), F.col("b.index") == F.col("a.index") + 1)
    assert near.filter("a.label >= b.label").count() == 0
    counts = FE.crosstab_long(df.withColumn("g", F.lit("one")), "g", "x")
    assert counts.count() == 100_001 and counts.filter("x = 'hot'").first()["n"] == 50_000
