"""Counts over manifests, outcomes and sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.functions.fields import is_fake, is_real
from clipledger.schema import CHAR_QUOTA


def label_counts(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count_if(is_real()).alias("reals"), F.count_if(is_fake()).alias("fakes"))


def done_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("method", "voice_model").agg(F.count(F.lit(1)).alias("done"))


def engine_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("voice_model").agg(
        F.count(F.lit(1)).alias("files")).orderBy("voice_model")


def voice_summary(outcomes: DataFrame) -> DataFrame:
    """Per voice: ok, errors and the seconds spent."""
    return outcomes.groupBy("voice").agg(
        F.count_if(F.col("error").isNull()).alias("ok"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.sum("elapsed_ms").alias("elapsed_ms"),
    )


def run_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.coalesce(F.sum("ok"), F.lit(0)).alias("ok"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
    )


def ingest_counts(members: DataFrame, elapsed_seconds: float) -> DataFrame:
    """Members (skipped, error) counted, with the extraction rate."""
    fresh = ~F.col("skipped")
    return members.agg(
        F.count_if(fresh & F.col("error").isNull()).alias("extracted"),
        F.count_if(F.col("skipped")).alias("skipped"),
        F.count_if(fresh & F.col("error").isNotNull()).alias("errors"),
    ).withColumn("per_second", F.try_divide(F.col("extracted"), F.lit(elapsed_seconds)))


def char_stats(sentences: DataFrame, *by: str) -> DataFrame:
    """Total and mean length, and how many sentences the character quota holds."""
    mean = F.try_divide(F.col("total_chars"), F.col("sentences"))
    return sentences.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sentences"), F.sum("char_count").alias("total_chars"),
    ).withColumn("mean_chars", mean).withColumn(
        "per_quota",
        F.floor(F.try_divide(F.lit(CHAR_QUOTA), F.floor("mean_chars"))).cast("bigint"))
