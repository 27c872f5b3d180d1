"""Keep fitted parameters (mode table, global mode, price cuts) as small Parquet tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfspark.operators.features import ModeImputer
from shelfspark.plans.retail import FeatureParams


def save_fitted(spark: SparkSession, params: FeatureParams, path: str) -> None:
    params.modes.write.mode("overwrite").parquet(f"{path}/modes")
    spark.createDataFrame(
        [(params.imputer.key, params.imputer.value,
          None if params.global_mode is None else float(params.global_mode), [float(c) for c in params.cuts])],
        "key string, value string, global_mode double, cuts array<double>",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/scalars")


def load_fitted(spark: SparkSession, path: str) -> FeatureParams:
    s = spark.read.parquet(f"{path}/scalars").first()
    modes = spark.read.parquet(f"{path}/modes")
    return FeatureParams(ModeImputer(s["key"], s["value"], modes, s["global_mode"]), list(s["cuts"]))
