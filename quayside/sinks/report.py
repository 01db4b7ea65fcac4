"""Load reports and the empty-batch rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("final_count", T.LongType(), True),
])


def load_report(table_name: str, written: DataFrame, status: str = "success") -> DataFrame:
    """``(table_name, status, final_count)``; the count is an aggregate over the
    freshly written snapshot (Parquet answers it from footers)."""
    return written.agg(F.count(F.lit(1)).cast("bigint").alias("final_count")).select(
        F.lit(table_name).alias("table_name"), F.lit(status).alias("status"), "final_count")


def skipped_report(spark: SparkSession, table_name: str, current: DataFrame | None) -> DataFrame:
    """An empty batch writes nothing; report the unchanged table count."""
    if current is None:
        return spark.createDataFrame([(table_name, "skipped", None)], REPORT_SCHEMA)
    return load_report(table_name, current, status="skipped")
