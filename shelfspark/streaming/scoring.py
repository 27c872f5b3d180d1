"""Score JSON sales records as they arrive (the request-at-a-time service, as a stream).

Stateless: features come from saved parameters (mode table, global mode,
price cuts) and the model from its saved weights, so no watermark or state is
needed. A stream cannot aggregate first, so the global-mode fallback is the
saved one. The mode table is a stream-static join. Each micro-batch goes through ``foreachBatch`` to a sink that a
repeated batch does not change: a partition of its own, replaced as a whole, or the keyed
predictions table, merged by key. A line that is no valid record is not
scored; its text goes to the reject folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfspark.operators.model import LinearModel
from shelfspark.plans.retail import FeatureParams, RetailConfig, feature_pipeline_apply
from shelfspark.session import materialize
from shelfspark.sources.tables import write_predictions


CORRUPT = "_corrupt_record"


def _records(spark: SparkSession, input_dir: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Records as a stream; a malformed line keeps its text in ``_corrupt_record``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return reader.text(input_dir).select(parsed.alias("r")).select("r.*")


def rejected_stream(spark: SparkSession, input_dir: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Texts of the malformed lines."""
    return _records(spark, input_dir, schema, max_files_per_trigger).filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def scored_stream(spark: SparkSession, input_dir: str, schema: T.StructType, cfg: RetailConfig,
                  params: FeatureParams, model: LinearModel, keep: tuple[str, ...] = (),
                  max_files_per_trigger: int | None = None) -> DataFrame:
    records = _records(spark, input_dir, schema, max_files_per_trigger)
    good = records.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    feats = feature_pipeline_apply(good, cfg, params, fallback=params.global_mode)
    return feats.select(*keep, *model.features, model.predict_expr().alias("pred_Sales"))


BATCH = "batch_id"


def write_batch(batch: DataFrame, batch_id: int, output_dir: str) -> None:
    """A micro-batch as one partition; the same batch again replaces its own partition and nothing else."""
    (batch.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH).parquet(output_dir))


def _start(out: DataFrame, checkpoint_location: str, sink, available_now: bool) -> StreamingQuery:
    writer = out.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_location).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def score_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_location: str,
                 schema: T.StructType, cfg: RetailConfig, params: FeatureParams, model: LinearModel,
                 keep: tuple[str, ...] = (), available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring stream into Parquet, one partition ``batch_id`` a micro-batch; ``available_now`` processes what is there and stops."""
    out = scored_stream(spark, input_dir, schema, cfg, params, model, keep, max_files_per_trigger)
    return _start(out, checkpoint_location, lambda batch, batch_id: write_batch(batch, batch_id, output_dir), available_now)


def score_stream_to_table(spark: SparkSession, input_dir: str, root: str, name: str, key: str, checkpoint_location: str,
                          schema: T.StructType, cfg: RetailConfig, params: FeatureParams, model: LinearModel,
                          keep: tuple[str, ...] = (), available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring stream into the keyed predictions table: each micro-batch is merged by ``key``, so a repeated batch
    changes nothing and a record that comes again takes its latest prediction. Within a batch a key may come once."""
    out = scored_stream(spark, input_dir, schema, cfg, params, model, (key, *keep), max_files_per_trigger)
    columns = [key, *keep, "pred_Sales"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch.select(*columns), "persist")  # the key check, the buckets and the join read it
        try:
            write_predictions(batch.sparkSession, root, name, rows, key, "merge")
        finally:
            rows.unpersist()

    return _start(out, checkpoint_location, merge, available_now)


def reject_stream(spark: SparkSession, input_dir: str, reject_dir: str, checkpoint_location: str, schema: T.StructType,
                  available_now: bool = True) -> StreamingQuery:
    """Start the stream that keeps malformed lines as text files."""
    writer = (rejected_stream(spark, input_dir, schema).writeStream.format("text").option("path", reject_dir)
              .option("checkpointLocation", checkpoint_location).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
