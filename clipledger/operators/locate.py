"""Matching manifest entries with stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.functions.fields import is_fake, is_real
from clipledger.functions.paths import basename, parent_name
from clipledger.operators.skew import lookup_join

# Folders that may hold a real clip, in order of preference.
REAL_FOLDERS = ["real", "real_tagarela"]


def inventory(listing: DataFrame) -> DataFrame:
    """Files by name and folder; `path` is relative to the data root."""
    return listing.select("path", parent_name("path").alias("parent"),
                          basename("path").alias("name"))


def locate_files(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Add `path` (NULL if there is none): the best file for each entry.

    Real: real/, then real_tagarela/, then any.  All other labels, and none:
    the voice's folder, then any path containing "fake", then any.  The
    smallest path wins a tie.  The inventory is reduced to one row per key
    before it meets the entries, so a name shared by many files and entries
    makes no pairs.
    """
    by_voice = files.groupBy("name", "parent").agg(
        F.min("path").alias("voice_path"),
        F.min(F.when(F.col("path").contains("fake"), F.col("path"))).alias("fake_path"))
    by_name = by_voice.groupBy("name").agg(
        F.min("voice_path").alias("any_path"), F.min("fake_path").alias("fake_path"),
        *[F.min(F.when(F.col("parent") == d, F.col("voice_path"))).alias(f"path_{d}")
          for d in REAL_FOLDERS],
    )
    voiced = lookup_join(
        entries, by_voice.select(F.col("name").alias("filename"), F.col("parent").alias("voice_model"),
                                 "voice_path"),
        ["filename", "voice_model"], "left").select(*entries.columns, "voice_path")
    real_path = F.coalesce(*[F.col(f"path_{d}") for d in REAL_FOLDERS], F.col("any_path"))
    other_path = F.coalesce("voice_path", "fake_path", "any_path")
    return lookup_join(
        voiced, by_name.withColumnRenamed("name", "filename"), ["filename"], "left",
    ).select(*entries.columns, F.when(is_real(), real_path).otherwise(other_path).alias("path"))


def carry_over(entries: DataFrame, updated: DataFrame) -> DataFrame:
    """Entries that were not moved, as they were."""
    return entries.join(updated.select("entry_seq"), "entry_seq", "left_anti")


def reconcile(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Per name: rows and files, and whether either side is missing.

    Both sides are counted per name first, so the outer join is one to one.
    """
    rows = entries.groupBy("filename").agg(F.count(F.lit(1)).alias("manifest_rows"))
    disk = files.groupBy(F.col("name").alias("filename")).agg(F.count(F.lit(1)).alias("files"))
    return rows.join(disk, "filename", "full_outer").select(
        "filename",
        F.coalesce("manifest_rows", F.lit(0)).alias("manifest_rows"),
        F.coalesce("files", F.lit(0)).alias("files"),
        F.when(F.col("files").isNull(), "missing_file")
        .when(F.col("manifest_rows").isNull(), "missing_row")
        .otherwise("ok").alias("status"),
    )


def real_fake_pairs(manifest: DataFrame) -> DataFrame:
    """Each fake that names a source, with the oldest real row of that name.

    `real_seq` is NULL for an orphan.
    """
    reals = manifest.where(is_real()).groupBy("filename").agg(
        F.min("entry_seq").alias("real_seq")).withColumnRenamed("filename", "source_file")
    fakes = manifest.where(is_fake() & (F.col("source_file") != ""))
    return lookup_join(fakes, reals, ["source_file"], "left").select(
        "entry_seq", "filename", "voice_model", "method", "source_file", "real_seq")
