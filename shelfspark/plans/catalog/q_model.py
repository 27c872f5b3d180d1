"""Split, fit, score, metrics, model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import model as M
from shelfspark.plans.catalog.base import register, table
from shelfspark.plans.catalog.q_features import _apply, _fit
from shelfspark.plans.retail import TESTDATA_PRESET as P
from shelfspark.session import materialize

_THRESH = M.split_threshold(0.7)
_FEATURES = ["Item_Weight", "Item_Visibility", "Item_MRP", "Outlet_Establishment_Year", "Outlet_Size",
             "Outlet_Location_Type"] + [f"Outlet_Type_{t}" for t in P.outlet_types]

_SPLIT_SQL = (f"CASE WHEN substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|28'), 1, 8) "
              f"< '{_THRESH}' THEN 'train' ELSE 'val' END")


@register("train_val_split", f"SELECT l_orderkey, l_linenumber, l_extendedprice, {_SPLIT_SQL} AS split FROM lineitem")
def q_train_val_split(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return M.train_val_split_tag(li, ["l_orderkey", "l_linenumber"], seed=28, train_frac=0.7)


@register("train_val_split_exact", """
WITH h AS (SELECT o_orderkey, o_totalprice,
                  CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|28'), 1, 15)) AS BIGINT) AS hv FROM orders)
SELECT o_orderkey, o_totalprice,
       CASE WHEN count(*) OVER (ORDER BY hv) <= floor(0.7 * count(*) OVER () + 0.5) THEN 'train' ELSE 'val' END AS split
FROM h""")
def q_train_val_split_exact(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    tr, va = M.train_val_split(o, ["o_orderkey"], seed=28, train_frac=0.7, exact_size=True)
    return tr.withColumn("split", F.lit("train")).unionByName(va.withColumn("split", F.lit("val")))


@register("fit_simple_linear", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem""")
def q_fit_simple_linear(spark, d):
    r = M.fit_simple_linear(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return r.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), "n")


@register("regression_metrics", f"""
WITH t AS (SELECT *, {_SPLIT_SQL} AS split FROM lineitem)
, m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM t WHERE split = 'train')
, p AS (SELECT split, l_extendedprice AS y, a + b * l_quantity AS yhat FROM t, m)
SELECT split, count(*) AS n, round(avg((y - yhat) * (y - yhat)), 4) AS mse, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
       round(1 - avg((y - yhat) * (y - yhat)) / var_pop(y), 8) AS r2
FROM p GROUP BY split""")
def q_regression_metrics(spark, d):
    li = M.train_val_split_tag(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], 28, 0.7)
    model = M.simple_model(li.filter(F.col("split") == "train"), "l_quantity", "l_extendedprice")
    out = None
    for side in ("train", "val"):
        r = M.regression_metrics(li.filter(F.col("split") == side), "l_extendedprice", model.predict_expr())
        r = r.select(F.lit(side).alias("split"), "n", F.round("mse", 4).alias("mse"), F.round("rmse", 6).alias("rmse"),
                     F.round("r2", 8).alias("r2"))
        out = r if out is None else out.unionByName(r)
    return out


def _trained(spark, d):
    _, test, feats, params = _fit(spark, d)
    model = M.fit_linear(feats, _FEATURES, "Item_Outlet_Sales")
    return test, feats, params, model


@register("fit_linear")
def q_fit_linear(spark, d):
    """Linear model on the train features; one row per feature weight plus the intercept."""
    _, _, _, model = _trained(spark, d)
    return model.coefficients_frame(spark)


@register("coefficients")
def q_coefficients(spark, d):
    """Weights sorted from most positive to most negative (the strongest predictors first and last)."""
    _, _, _, model = _trained(spark, d)
    return model.coefficients_frame(spark).filter(F.col("feature") != "intercept").orderBy(F.desc("weight"))


@register("score_batch")
def q_score_batch(spark, d):
    test, _, params, model = _trained(spark, d)
    applied = _apply(test, params)
    return M.score_batch(applied, model, "pred_Sales").select("l_orderkey", "l_linenumber", *_FEATURES, "pred_Sales")


@register("train_metrics")
def q_train_metrics(spark, d):
    """RMSE and R2 of the multi-feature model on its train and validation split (hash split, seed 28)."""
    _, _, feats, _ = _fit(spark, d)
    tagged = M.train_val_split_tag(feats, ["l_orderkey", "l_linenumber"], 28, 0.7)
    rows = materialize(tagged.select("split", *_FEATURES, "Item_Outlet_Sales"), "persist")  # three passes read them
    try:
        model = M.fit_linear(rows.filter(F.col("split") == "train"), _FEATURES, "Item_Outlet_Sales")
        got = M.regression_metrics(rows, "Item_Outlet_Sales", model.predict_expr(), by=["split"])
        return spark.createDataFrame(got.collect(), got.schema)  # two rows
    finally:
        rows.unpersist()


@register("compare_models")
def q_compare_models(spark, d):
    """New model (all features) against the current one (price bin only) on the new rows."""
    _, test, feats, params = _fit(spark, d)
    rows = materialize(feats.select(*_FEATURES, "Item_Outlet_Sales"), "persist")  # two passes read them
    try:
        sums = M.gram(rows, [*_FEATURES, "Item_Outlet_Sales"])  # the price-only model is a sub-block of it
    finally:
        rows.unpersist()
    new_model = M.fit_from_gram(sums, _FEATURES, "Item_Outlet_Sales")
    old_model = M.fit_from_gram(sums, ["Item_MRP"], "Item_Outlet_Sales")
    applied = _apply(test, params)
    scored = applied.select("Item_Outlet_Sales", new_model.predict_expr().alias("pred_new"),
                            old_model.predict_expr().alias("pred_old"))
    c = M.compare_models(scored, "Item_Outlet_Sales", "pred_new", "pred_old")
    w = c.wilcoxon
    return spark.createDataFrame([(c.r2_new, c.r2_old, w.statistic if w else None, w.p_value if w else None, c.accept)],
                                 "r2_new double, r2_old double, wilcoxon double, p_value double, accept boolean")
