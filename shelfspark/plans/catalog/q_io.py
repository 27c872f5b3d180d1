"""Sources and sinks as round trips over the given tables.

Each query writes to a fresh folder under the cluster's shared checkpoint
directory and returns what it reads back, so the oracle is the source table.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators import model as M
from shelfspark.plans.catalog.base import CUT, register, sales_view, scratch, table, with_sales
from shelfspark.plans.catalog.q_features import _TRAIN_CTES, _apply, _fit
from shelfspark.sources import files as FI
from shelfspark.sources import fitted as FT
from shelfspark.sources import tables as TB

_PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType()),
])


@register("read_csv", "SELECT * FROM part")
def q_read_csv(spark, d):
    path = scratch(spark, "read_csv")
    FI.write_csv(table(spark, d, "part"), path)
    return FI.read_csv(spark, path, _PART_SCHEMA)


@register("write_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def q_write_csv(spark, d):
    path = scratch(spark, "write_csv")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    FI.write_csv(o, path)
    return FI.read_csv(spark, path, o.schema)


@register("read_table", "SELECT * FROM part")
def q_read_table(spark, d):
    root = scratch(spark, "tables")
    p = table(spark, d, "part")
    TB.create_keyed_table(spark, root, "part_features", p.schema, ["p_partkey"], "parts", df=p)
    return TB.read_table(spark, root, "part_features")


@register("create_keyed_table", "SELECT * FROM orders")
def q_create_keyed_table(spark, d):
    root = scratch(spark, "tables")
    o = table(spark, d, "orders")
    created = TB.create_keyed_table(spark, root, "orders_raw", o.schema, ["o_orderkey"], "raw orders", df=o)
    again = TB.create_keyed_table(spark, root, "orders_raw", o.schema, ["o_orderkey"], "raw orders", df=o)
    assert created and not again
    return TB.read_table(spark, root, "orders_raw")


@register("overwrite_table", "SELECT * REPLACE (CAST(p_size + 1 AS INTEGER) AS p_size) FROM part")
def q_overwrite_table(spark, d):
    root = scratch(spark, "tables")
    p = table(spark, d, "part")
    TB.create_keyed_table(spark, root, "parts", p.schema, ["p_partkey"], df=p)
    TB.write_table(spark, root, "parts", p.withColumn("p_size", F.col("p_size") + 1), mode="overwrite")
    return TB.read_table(spark, root, "parts")


@register("merge_table", """
WITH old AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'),
new AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00')
SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new""")
def q_merge_table(spark, d):
    root = scratch(spark, "tables")
    o = table(spark, d, "orders")
    old = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderstatus")
    TB.create_keyed_table(spark, root, "orders_hist", old.schema, ["o_orderkey"], df=old)
    TB.write_table(spark, root, "orders_hist", new, mode="merge")
    TB.write_table(spark, root, "orders_hist", new, mode="merge")  # merging twice equals once
    return TB.read_table(spark, root, "orders_hist")


@register("snapshot_table", with_sales(f"""
SELECT l_orderkey, l_linenumber, Item_MRP, Item_Outlet_Sales FROM sales WHERE date_created <= DATE '{CUT}'"""))
def q_snapshot_table(spark, d):
    path = scratch(spark, "snapshots")
    s = sales_view(spark, d, ["l_orderkey", "l_linenumber", "Item_MRP", "Item_Outlet_Sales", "date_created"])
    ref = s.filter(F.col("date_created") <= F.lit(CUT).cast("date")).drop("date_created")
    TB.snapshot_table(ref, path, "job1", "2024-01-02")
    TB.snapshot_table(s.drop("date_created"), path, "job1", "2024-01-03")
    TB.snapshot_table(ref, path, "job1", "2024-01-02")  # rerun replaces only its own partition
    return TB.read_snapshot(spark, path, "job1", "2024-01-02")


@register("read_lookup", "SELECT DISTINCT p_type AS value FROM part")
def q_read_lookup(spark, d):
    path = scratch(spark, "lookup")
    table(spark, d, "part").select("p_type").distinct().coalesce(1).write.text(path)
    return FI.read_lookup(spark, path)


@register("read_lookup_json", "SELECT DISTINCT p_type AS value FROM part")
def q_read_lookup_json(spark, d):
    path = scratch(spark, "lookup_json")
    table(spark, d, "part").agg(F.sort_array(F.collect_set("p_type")).alias("types")).coalesce(1).write.json(path)
    return FI.read_lookup(spark, path, key="types")


@register("read_records", """
SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS VARCHAR) AS _corrupt_record FROM events""")
def q_read_records(spark, d):
    path = scratch(spark, "records")
    e = table(spark, d, "events")
    rec = e.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value",
                                      F.get_json_object("props", "$.k").cast("int").alias("k"))).alias("value"))
    rec.write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                           T.StructField("k", T.IntegerType())])
    return FI.read_records(spark, path, schema)


@register("save_load_fitted", with_sales(_TRAIN_CTES + "SELECT 'mode' AS part, Item_Identifier AS name, mode AS value FROM gap_table "
          "UNION ALL SELECT 'global', '', (SELECT gmode FROM train_gmode) " + " ".join(
              f"UNION ALL SELECT 'cut', '{i}', round(quantile_cont(Item_MRP, {i / 4}), 6) FROM train_filled" for i in range(5))))
def q_save_load_fitted(spark, d):
    path = scratch(spark, "fitted")
    _, _, _, params = _fit(spark, d)
    FT.save_fitted(spark, params, path)
    back = FT.load_fitted(spark, path)
    rest = [("global", "", float(back.global_mode))] + [("cut", str(i), round(c, 6)) for i, c in enumerate(back.cuts)]
    modes = back.modes.select(F.lit("mode").alias("part"), F.col("Item_Identifier").alias("name"), F.col("mode").cast("double").alias("value"))
    return modes.unionByName(spark.createDataFrame(rest, "part string, name string, value double"))


@register("write_predictions")
def q_write_predictions(spark, d):
    from shelfspark.plans.catalog.q_model import _trained

    root = scratch(spark, "tables")
    test, _, params, model = _trained(spark, d)
    scored = M.score_batch(_apply(test, params), model, "pred_Sales")
    # (l_orderkey, l_linenumber) repeats in lineitem: the id adds the row's number among equal keys, by prediction.
    turn = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("pred_Sales"))
    keyed = scored.select(F.concat_ws("-", "l_orderkey", "l_linenumber", turn).alias("item_id"), "l_orderkey", "l_linenumber", "pred_Sales")
    TB.write_predictions(spark, root, "predictions", keyed, "item_id")
    return TB.read_table(spark, root, "predictions")


@register("write_metrics")
def q_write_metrics(spark, d):
    from shelfspark.plans.catalog.q_model import _FEATURES

    path = scratch(spark, "metrics")
    _, _, feats, _ = _fit(spark, d)
    model = M.fit_linear(feats, _FEATURES, "Item_Outlet_Sales")
    m = M.regression_metrics(feats, "Item_Outlet_Sales", model.predict_expr()).first().asDict()
    FI.write_metrics(spark, m, path)
    return spark.read.json(path)
