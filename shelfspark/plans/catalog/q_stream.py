"""Streaming scoring over record files written from the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfspark.operators import model as M
from shelfspark.plans.catalog.base import CUT, register, scratch, with_sales
from shelfspark.plans.catalog.q_features import _fit
from shelfspark.plans.catalog.q_model import _FEATURES
from shelfspark.plans.retail import TESTDATA_PRESET as P
from shelfspark.session import materialize
from shelfspark.sources.tables import read_table
from shelfspark.streaming.scoring import score_stream, score_stream_to_table

_BATCHES = 3


@register("score_stream")
def q_score_stream(spark, d):
    """New rows written as JSON record files, scored by a stream with the saved
    parameters; returns what the stream's sink holds (same rows as batch scoring)."""
    _, test, feats, params = _fit(spark, d)
    model = M.fit_linear(feats, _FEATURES, "Item_Outlet_Sales")
    base = scratch(spark, "stream")
    records = test.drop("date_created")
    records.write.json(f"{base}/in")
    q = score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", records.schema, P, params, model,
                     keep=("l_orderkey", "l_linenumber"))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@register("stream_predictions", with_sales(f"""
, keyed AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY Item_Outlet_Sales, Item_MRP, Outlet_Identifier) AS turn
            FROM sales WHERE date_created > DATE '{CUT}')
SELECT l_orderkey || '-' || l_linenumber || '-' || turn AS item_id, l_orderkey, l_linenumber, 1 AS scored FROM keyed"""))
def q_stream_predictions(spark, d):
    """The keyed predictions table that a stream of several micro-batches fills by merging; the oracle holds its ids."""
    _, test, feats, params = _fit(spark, d)
    rows = materialize(feats.select(*_FEATURES, "Item_Outlet_Sales"), "persist")  # two passes read them
    try:
        model = M.fit_linear(rows, _FEATURES, "Item_Outlet_Sales")
    finally:
        rows.unpersist()
    base = scratch(spark, "stream")
    turn = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("Item_Outlet_Sales", "Item_MRP", "Outlet_Identifier"))
    records = test.withColumn("item_id", F.concat_ws("-", "l_orderkey", "l_linenumber", turn)).drop("date_created")
    # As many files a micro-batch as a shuffle has parts in three batches, so all cores write and read them.
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // _BATCHES)
    records.repartition(_BATCHES * files, "item_id").write.json(f"{base}/in")
    q = score_stream_to_table(spark, f"{base}/in", base, "predictions", "item_id", f"{base}/ckpt", records.schema, P, params, model,
                              keep=("l_orderkey", "l_linenumber"), max_files_per_trigger=files)
    q.awaitTermination()
    table = read_table(spark, base, "predictions")
    return table.select("item_id", "l_orderkey", "l_linenumber", F.col("pred_Sales").isNotNull().cast("int").alias("scored"))
