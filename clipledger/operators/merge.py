"""Growing the manifest: insert-only merge, unions, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.functions.fields import entries
from clipledger.operators.ordering import global_position, keep_first
from clipledger.operators.pending import set_difference
from clipledger.schema import FAKE, MANIFEST_FIELDS, REAL


def append_union(*parts: DataFrame) -> DataFrame:
    """Bag union by column name; repeated rows stay."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def incoming_entries(clips: DataFrame, converted: DataFrame, method: str,
                     generated_at: Column | str, params: dict | None = None) -> DataFrame:
    """Rows a run offers: every real clip, then the converted clips.

    clips: filename.  converted: voice, filename, source_path and ord, the
    turn of the voice.  `part`, `ord` and `origin` give the order of the offer.
    """
    reals = entries(
        clips.select("filename", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("ord"),
                     F.col("filename").alias("origin")), REAL, "")
    fakes = entries(
        converted.select(
            "filename", F.col("voice").alias("voice_model"),
            F.substring_index("source_path", "/", -1).alias("source_file"),
            F.lit(1).alias("part"), F.col("ord").cast("bigint").alias("ord"),
            F.col("source_path").alias("origin"),
        ), FAKE, method, params, generated_at)
    return reals.unionByName(fakes)


def new_entries(manifest: DataFrame, offered: DataFrame, *order: str) -> DataFrame:
    """Offered rows whose (filename, voice_model) is new, first per key.

    A NULL in the key is a blank, on either side.
    """
    key = ["filename", "voice_model"]

    def blank(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(c, F.lit("")) for c in key})

    once = keep_first(blank(offered), key, *order)
    return set_difference(once, blank(manifest), *key, unique=True)


def merge_rows(manifest: DataFrame, offered: DataFrame, *order: str) -> DataFrame:
    """Only the new rows, numbered after the ledger's last: what a store has to append."""
    last = manifest.agg(F.max("entry_seq").alias("last")).first()["last"]
    fresh = global_position(
        new_entries(manifest, offered, *order), *order, "filename", "voice_model",
        name="entry_seq", start=0 if last is None else last + 1)
    return fresh.select("entry_seq", *MANIFEST_FIELDS)


def manifest_merge(manifest: DataFrame, offered: DataFrame, *order: str) -> DataFrame:
    """The ledger with the new rows behind it; nothing is updated."""
    return append_union(manifest.select("entry_seq", *MANIFEST_FIELDS), merge_rows(manifest, offered, *order))
