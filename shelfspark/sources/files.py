"""CSV, JSON records, lookup lists and metric files."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Request-record schema of the raw sales record (fixed column names and types).
SALES_RECORD_SCHEMA = T.StructType([
    T.StructField("Item_Identifier", T.StringType()),
    T.StructField("Item_Weight", T.DoubleType()),
    T.StructField("Item_Fat_Content", T.StringType()),
    T.StructField("Item_Visibility", T.DoubleType()),
    T.StructField("Item_Type", T.StringType()),
    T.StructField("Item_MRP", T.DoubleType()),
    T.StructField("Outlet_Identifier", T.StringType()),
    T.StructField("Outlet_Establishment_Year", T.IntegerType()),
    T.StructField("Outlet_Size", T.StringType()),
    T.StructField("Outlet_Location_Type", T.StringType()),
    T.StructField("Outlet_Type", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass).

    Missing values written as empty text or as NaN become null (Spark's missing value)."""
    df = (spark.read.option("header", header).option("nanValue", "NaN").option("nullValue", "")
          .option("mode", "PERMISSIVE").schema(schema).csv(path))
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in floats else F.col(c)
                       for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and no index column; one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Typed JSON records (one object per line); malformed lines keep their text in ``corrupt_col``."""
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    return (spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
            .json(path))


def read_lookup(spark: SparkSession, path: str, key: str | None = None, out: str = "value") -> DataFrame:
    """Lookup values: one per text line (line ends stripped), or the array ``key`` of a JSON object file."""
    if key is None:
        return spark.read.text(path).select(F.rtrim(F.regexp_replace("value", r"[\r\n]+$", "")).alias(out)) \
            .filter(F.col(out) != "")
    return spark.read.option("multiLine", True).json(path).select(F.explode(F.col(key)).alias(out))


def write_metrics(spark: SparkSession, metrics: dict[str, Any], path: str, mode: str = "overwrite") -> DataFrame:
    """Metrics as one JSON object (one-row frame); returns the frame."""
    df = spark.createDataFrame([tuple(metrics.values())], list(metrics.keys()))
    df.coalesce(1).write.mode(mode).json(path)
    return df
