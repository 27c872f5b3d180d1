"""Keyed tables (merge twice equals once), stream equals batch, drift distances against brute force."""

import bisect
import uuid

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import drift as DR
from shelfspark.sources import tables as TB


def _root(spark):
    from shelfspark.session import scratch_path

    return scratch_path(spark, "test-" + uuid.uuid4().hex[:8])


def test_feature_table_round_trip_and_merge(spark):
    root = _root(spark)
    df = spark.createDataFrame([(i, i, 500 + i) for i in range(500)], "item_id long, x long, y long")
    assert TB.create_keyed_table(spark, root, "test", df.schema, ["item_id"], "toy", df=df)
    assert not TB.create_keyed_table(spark, root, "test", df.schema, ["item_id"])
    TB.write_table(spark, root, "test", df, mode="merge")
    TB.write_table(spark, root, "test", df, mode="merge")
    back = TB.read_table(spark, root, "test")
    assert back.count() == 500 and back.columns == ["item_id", "x", "y"]
    upd = spark.createDataFrame([(1, 100), (1000, 5)], "item_id long, x long")
    TB.write_table(spark, root, "test", upd, mode="merge")
    got = {r["item_id"]: (r["x"], r["y"]) for r in TB.read_table(spark, root, "test").collect()}
    assert len(got) == 501 and got[1] == (100, 501) and got[2] == (2, 502) and got[1000] == (5, None)
    with pytest.raises(TB.KeyError_, match="extra"):
        TB.write_table(spark, root, "test", upd.withColumn("extra", F.lit(1)), mode="merge")
    assert TB.read_table(spark, root, "test").count() == 501


def test_merge_rewrites_only_the_buckets_it_touches(spark):
    root = _root(spark)
    df = spark.createDataFrame([(i, f"v{i}") for i in range(300)], "id long, v string")
    TB.create_keyed_table(spark, root, "b", df.schema, ["id"], df=df, buckets=8)
    files = lambda: {r["f"] for r in spark.read.parquet(f"{root}/b/rows").select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    touched = TB.write_table(spark, root, "b", spark.createDataFrame([(7, "new"), (1007, "more")], "id long, v string"), mode="merge")
    assert 1 <= len(touched) <= 2
    kept = [f for f in before if not any(f"{TB.BUCKET}={k}/" in f for k in touched)]
    assert set(kept) == {f for f in files() if not any(f"{TB.BUCKET}={k}/" in f for k in touched)} and len(kept) >= 6
    got = {r["id"]: r["v"] for r in TB.read_table(spark, root, "b").collect()}
    assert len(got) == 301 and got[7] == "new" and got[1007] == "more" and got[8] == "v8"
    assert TB.write_table(spark, root, "b", df.filter("id < 0"), mode="merge") == []
    TB.write_table(spark, root, "b", df.filter("id < 10"))
    assert TB.read_table(spark, root, "b").count() == 10


def test_empty_and_missing_tables(spark):
    root = _root(spark)
    schema = spark.createDataFrame([], "id long, v string").schema
    assert not TB.table_exists(spark, root, "none")
    with pytest.raises(TB.KeyError_):
        TB.read_table(spark, root, "none")
    assert TB.create_keyed_table(spark, root, "e", schema, ["id"], "nothing yet")
    back = TB.read_table(spark, root, "e")
    assert back.columns == ["id", "v"] and back.count() == 0
    assert TB.meta(spark, root, "e")["description"] == "nothing yet"
    TB.write_table(spark, root, "e", spark.createDataFrame([(1, "a")], schema), mode="merge")
    assert TB.read_table(spark, root, "e").count() == 1
    with pytest.raises(TB.KeyError_):
        TB.create_keyed_table(spark, root, "x", spark.createDataFrame([], "key_bucket int").schema, ["key_bucket"])


def test_a_repeated_micro_batch_changes_nothing(spark):
    from shelfspark.streaming import scoring

    out = _root(spark) + "/out"
    first, second = (spark.createDataFrame([(i, float(i)) for i in ids], "id long, pred_Sales double") for ids in ([1, 2, 3], [4, 5]))
    rows = lambda: sorted(tuple(r) for r in spark.read.parquet(out).select("batch_id", "id", "pred_Sales").collect())
    scoring.write_batch(first, 0, out)
    scoring.write_batch(second, 1, out)
    once = rows()
    scoring.write_batch(first, 0, out)
    scoring.write_batch(second, 1, out)
    assert rows() == once and len(once) == 5


def test_stream_fills_the_keyed_table_in_batches(spark):
    """Several micro-batches, then a stream that starts over without its checkpoint: the table equals batch scoring both times."""
    from pyspark.sql import types as T

    from shelfspark.operators.model import score_batch
    from shelfspark.plans.catalog.q_model import _trained
    from shelfspark.plans.retail import TESTDATA_PRESET as P
    from shelfspark.plans.retail import feature_pipeline_apply
    from shelfspark.streaming import scoring

    base = _root(spark)
    test, _, params, model = _trained(spark, "/root/testdata/sf0.001")
    records = test.withColumn("item_id", F.monotonically_increasing_id()).drop("date_created").persist()
    records.repartition(3).write.json(f"{base}/in")
    schema = T.StructType([f for f in records.schema.fields])
    batch = score_batch(feature_pipeline_apply(records, P, params, fallback=params.global_mode), model, "pred_Sales")
    want = sorted((r["item_id"], round(r["pred_Sales"], 6)) for r in batch.select("item_id", "pred_Sales").collect())
    for run in (1, 2):
        scoring.score_stream_to_table(spark, f"{base}/in", base, "predictions", "item_id", f"{base}/ckpt{run}", schema, P, params, model,
                                      max_files_per_trigger=1).awaitTermination()
        got = sorted((r["item_id"], round(r["pred_Sales"], 6)) for r in TB.read_table(spark, base, "predictions").collect())
        assert got == want and len(got) > 10
    scoring.score_stream(spark, f"{base}/in", f"{base}/parts", f"{base}/ckpt3", schema, P, params, model, keep=("item_id",),
                         max_files_per_trigger=1).awaitTermination()
    parts = spark.read.parquet(f"{base}/parts")
    assert parts.select("batch_id").distinct().count() == 3
    assert sorted((r["item_id"], round(r["pred_Sales"], 6)) for r in parts.collect()) == want
    records.unpersist()


def test_malformed_records_are_kept_apart(spark):
    from pyspark.sql import types as T

    from shelfspark.streaming import scoring

    base = _root(spark)
    spark.createDataFrame([('{"a": 1, "b": 2.0}',), ('{"a": 1, "b": ',), ("no json",)], "value string").coalesce(1).write.text(f"{base}/in")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    scoring.reject_stream(spark, f"{base}/in", f"{base}/bad", f"{base}/ckpt", schema).awaitTermination()
    assert {r["value"] for r in spark.read.text(f"{base}/bad").collect()} == {'{"a": 1, "b": ', "no json"}
    good = scoring._records(spark, f"{base}/in", schema).filter(F.col(scoring.CORRUPT).isNull()).drop(scoring.CORRUPT)
    good.writeStream.format("parquet").option("path", f"{base}/good").option("checkpointLocation", f"{base}/ckpt2").trigger(
        availableNow=True).start().awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{base}/good").collect()] == [(1, 2.0)]


def test_every_column_has_a_drift_row(spark):
    """A new category, a constant column, a column null in one period, and one null in both."""
    schema = "cat string, same string, gone double, never double, x double"
    ref = spark.createDataFrame([("a", "k", 1.0, None, float(i)) for i in range(40)], schema)
    cur = spark.createDataFrame([("b" if i % 2 else "a", "k", None, None, float(i)) for i in range(40)], schema)
    for small in (None, 1000):
        rep = {r["feature"]: r for r in DR.drift_report(ref, cur, rules=DR.DriftRules(small_reference_rows=small)).collect()}
        assert set(rep) == {"cat", "same", "gone", "never", "x"}
        assert rep["cat"]["drift"] and rep["cat"]["status"] == "ok"
        assert not rep["same"]["drift"] and not rep["x"]["drift"] and rep["same"]["status"] == "ok"
        assert rep["gone"]["drift"] and rep["gone"]["status"] == "no_current_values" and rep["gone"]["score"] is None
        assert not rep["never"]["drift"] and rep["never"]["status"] == "no_values"
    named = DR.drift_report(ref, cur, ["x", "cat"], DR.DriftRules(tests=(("x", "ks"), ("cat", "chisquare"))))
    assert {r["feature"]: r["test"] for r in named.collect()} == {"x": "ks", "cat": "chisquare"}


def test_key_check(spark):
    root = _root(spark)
    df = spark.createDataFrame([(1, 1), (1, 2)], "item_id long, x long")
    TB.create_keyed_table(spark, root, "dup", df.schema, ["item_id"])
    with pytest.raises(TB.KeyError_):
        TB.write_table(spark, root, "dup", df)


def test_stream_equals_batch(spark):
    from __spark_entry__ import queries
    from shelfspark.operators.model import score_batch
    from shelfspark.plans.catalog.q_model import _trained
    from shelfspark.plans.retail import TESTDATA_PRESET as P
    from shelfspark.plans.retail import feature_pipeline_apply

    d = "/root/testdata/sf0.001"
    streamed = queries()["score_stream"](spark, d)
    test, _, params, model = _trained(spark, d)
    # The stream falls back to the saved global mode; batch with the same fallback must agree.
    batch = score_batch(feature_pipeline_apply(test, P, params, fallback=params.global_mode), model, "pred_Sales")
    a = sorted((r["l_orderkey"], r["l_linenumber"], round(r["pred_Sales"], 6)) for r in streamed.collect())
    b = sorted((r["l_orderkey"], r["l_linenumber"], round(r["pred_Sales"], 6)) for r in batch.collect())
    assert a == b


def _ecdf(xs, v):
    return bisect.bisect_right(xs, v) / len(xs)


def test_ks_and_wasserstein_brute_force(spark):
    ref = [1.0, 2.0, 2.0, 3.0, 7.0]
    cur = [2.0, 4.0, 4.0, 5.0]
    r = spark.createDataFrame([(x,) for x in ref], "x double")
    c = spark.createDataFrame([(x,) for x in cur], "x double")
    pts = sorted(set(ref + cur))
    d = max(abs(_ecdf(sorted(ref), v) - _ecdf(sorted(cur), v)) for v in pts)
    w = sum(abs(_ecdf(sorted(ref), a) - _ecdf(sorted(cur), a)) * (b - a) for a, b in zip(pts, pts[1:]))
    assert DR.ks_frame(r, c, ["x"]).first()["ks_d"] == pytest.approx(d)
    row = DR.wasserstein_frame(r, c, ["x"]).first()
    mean = sum(ref) / len(ref)
    std = (sum((x - mean) ** 2 for x in ref) / len(ref)) ** 0.5
    assert row["distance"] == pytest.approx(w) and row["normed"] == pytest.approx(w / std)


def test_drift_decision_threshold(spark):
    rows = [(f"c{i}", "num", "ks", 0.01, 0.05, i < 5) for i in range(7)]
    rep = spark.createDataFrame(rows, "feature string, kind string, test string, score double, threshold double, drift boolean")
    assert DR.drift_decision(rep).first()["drift"] is True
    assert DR.drift_decision(rep.filter(F.col("feature") != "c0")).first()["drift"] is False


def test_read_csv_nan_and_empty_become_null(spark):
    from shelfspark.sources.files import SALES_RECORD_SCHEMA, read_csv

    path = _root(spark) + "/raw"
    lines = ["Item_Identifier,Item_Weight,Item_Fat_Content,Item_Visibility,Item_Type,Item_MRP,Outlet_Identifier,"
             "Outlet_Establishment_Year,Outlet_Size,Outlet_Location_Type,Outlet_Type",
             "FDA15,9.3,Low Fat,0.016,Dairy,249.8,OUT049,1999,Medium,Tier 1,Supermarket Type1",
             "FDX07,NaN,Regular,0.0,Fruits and Vegetables,182.1,OUT010,1998,,Tier 3,Grocery Store",
             "FDX08,,Regular,0.0,Dairy,182.1,OUT010,1998,,Tier 3,Grocery Store"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = read_csv(spark, path, SALES_RECORD_SCHEMA).collect()
    assert [r["Item_Weight"] for r in rows] == [9.3, None, None]
    assert [r["Outlet_Size"] for r in rows] == ["Medium", None, None]
    assert rows[0]["Outlet_Establishment_Year"] == 1999


def test_key_check_null(spark):
    root = _root(spark)
    df = spark.createDataFrame([(1, 1), (None, 2)], "item_id long, x long")
    TB.create_keyed_table(spark, root, "nul", df.schema, ["item_id"])
    with pytest.raises(TB.KeyError_, match="null"):
        TB.write_table(spark, root, "nul", df)


def test_small_reference_uses_p_value_tests(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    ref = li.filter(F.col("l_orderkey") < 200)   # a few hundred reference rows
    cur = li.filter(F.col("l_orderkey") >= 200)
    rep = {r["feature"]: r for r in DR.drift_report(
        ref, cur, ["l_extendedprice", "l_returnflag", "l_linestatus", "l_tax"], DR.DriftRules(small_reference_rows=1000)).collect()}
    assert ref.count() <= 1000
    assert rep["l_extendedprice"]["test"] == "ks"
    assert rep["l_returnflag"]["test"] == "chisquare"
    assert rep["l_linestatus"]["test"] == "z"
    assert rep["l_tax"]["test"] == "ks"          # 9 distinct values: more than five
    for r in rep.values():
        assert 0.0 <= r["score"] <= 1.0 and r["drift"] == (r["score"] < 0.05)


def test_stream_predictions_writes_and_reads_in_many_files(spark, monkeypatch):
    """Three micro-batches of several files each: three files would be written by three tasks, whatever the cluster."""
    import glob

    from shelfspark.plans.catalog import q_stream

    base = _root(spark).removeprefix("file:")
    monkeypatch.setattr(q_stream, "scratch", lambda spark, name: base)
    rows = q_stream.q_stream_predictions(spark, "/root/testdata/sf0.001")
    files, per_batch = glob.glob(f"{base}/in/*.json"), int(spark.conf.get("spark.sql.shuffle.partitions")) // 3
    assert 3 < len(files) <= 3 * per_batch
    assert 1 < len(glob.glob(f"{base}/ckpt/commits/[0-9]*")) <= 3
    read = spark.read.json(f"{base}/in")
    assert rows.select("item_id").distinct().count() == rows.count() == read.count() > 10
