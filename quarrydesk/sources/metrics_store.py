"""Metric rows by run; writing a run again replaces it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append_metrics(row: DataFrame, path: str, run_id: str) -> None:
    """Numeric columns of metric rows as (run_id, metric, value); other columns stay as keys.

    A run is a partition of the table: the same run written twice, after a retry for one, leaves one set of rows, and
    other runs stay as they are.
    """
    numeric = [f.name for f in row.schema.fields if isinstance(f.dataType, T.NumericType)]
    keys = [c for c in row.columns if c not in numeric]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numeric])
    shaped = row.select(F.lit(run_id).alias("run_id"), *keys, F.inline(pairs))
    shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``run_id`` first; ids that look like numbers stay text."""
    found = spark.read.parquet(path)
    rest = [f for f in found.schema.fields if f.name != "run_id"]
    return spark.read.schema(T.StructType([T.StructField("run_id", T.StringType()), *rest])).parquet(path).select(
        "run_id", *[f.name for f in rest])
