"""Remote samples as a table or a stream, filtered before any payload is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipledger.schema import ACCENT, SAMPLES


def samples(spark: SparkSession, path: str, accent: str = ACCENT,
            schema: T.StructType = SAMPLES, accent_column: str = "accent",
            **options: str) -> DataFrame:
    table = spark.read.schema(schema).options(**options).parquet(path)
    return table.where(F.col(accent_column) == accent)


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100,
             bytes_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Parquet files as a stream, with `arrival`: time and path of the file, and the row in it.

    One flush has `files_per_trigger` files, or as many as hold `bytes_per_trigger`.
    """
    bound = ("maxFilesPerTrigger", files_per_trigger) if bytes_per_trigger is None else (
        "maxBytesPerTrigger", bytes_per_trigger)
    return spark.readStream.schema(schema).option(*bound).options(**options).parquet(path).withColumn(
        "arrival", F.struct(F.col("_metadata.file_modification_time").alias("at"),
                            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def sample_stream(spark: SparkSession, path: str, accent: str = ACCENT,
                  schema: T.StructType = SAMPLES, accent_column: str = "accent", **options) -> DataFrame:
    """The samples of one accent as a stream; see `arriving` for the options."""
    return arriving(spark, path, schema, **options).where(F.col(accent_column) == accent)
