"""Bringing clips in: archive members, remote samples, engine clips, sentences."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions.fields import entries
from clipledger.functions.paths import speech_name, wav_for_engine_clip
from clipledger.functions.signal import downmix, quantise
from clipledger.operators.names import sequence_assign
from clipledger.operators.ordering import keep_first
from clipledger.operators.outcomes import convert_until, successes
from clipledger.operators.pending import (
    head_limit, pending_by_key, pending_members, set_difference, skipped_members,
)
from clipledger.schema import (
    FAKE, IMPORT_TIME, METHOD_SAMPLES, METHOD_SPEECH, REAL,
)
from clipledger.session import stored
from clipledger.sources.archives import archive_members, with_payloads

CLIP_SUFFIX = ".mp3"   # fixed value: what corpora store clips as


def signal_levels(frames: Column) -> Column:
    """Channel frames to 16-bit levels."""
    return quantise(downmix(frames))


def new_samples(samples: DataFrame, stored_sources: DataFrame, *order: str) -> DataFrame:
    """Samples not stored yet, first per source_file.

    A sample without a path (blank or NULL) has no identity and is always new;
    its source_file becomes blank.
    """
    samples = samples.withColumn("source_file", F.coalesce("source_file", F.lit("")))
    known = F.col("source_file") != ""
    once = keep_first(samples.where(known), ["source_file"], *order)
    fresh = set_difference(once, stored_sources, "source_file", unique=True)
    nameless = samples.where(~known)
    # A look at one column spares a second read of the payloads.
    return fresh if nameless.isEmpty() else fresh.unionByName(nameless)


def sample_entries(outcomes: DataFrame, target: int, done: int, start: int,
                   generated_at: Column | str, *order: str) -> DataFrame:
    """Manifest rows (with index) for the successes still wanted, in order.

    Failures take no number and do not count toward the target.  The number
    also tells whether a row is within the target, so one ordering does both.
    """
    keys = list(dict.fromkeys(["source_file", *order]))
    named = sequence_assign(successes(outcomes).select(keys), start, *order)
    wanted = named.where(F.col("index") < start + max(target - done, 0))
    return entries(wanted.select("index", "filename", "source_file"), REAL, METHOD_SAMPLES,
                   generated_at=generated_at)


class Extraction(NamedTuple):
    outcomes: DataFrame | None   # archive, seq, member, wav_name and what `convert` added
    skipped: DataFrame           # members whose clip was there before


def run_extraction(spark: SparkSession, archives: list[str] | DataFrame, existing: DataFrame, wanted: int,
                   convert: Callable[[DataFrame], DataFrame]) -> Extraction:
    """Extract the clips among archive members until `wanted` are extracted, in archive order.

    archives: their paths, or a listing with `path` if there are many.
    existing: filename of the clips extracted before.  `convert` gets archive,
    seq, member, wav_name and content, and adds `error`.  Names are listed
    without payloads, once; then only payloads of members still wanted are
    handed on, and an archive is read up to the last of them.
    """
    names = stored(archive_members(spark, archives, CLIP_SUFFIX, content=False).drop("content"), "members")
    work = pending_members(names, existing).select("archive", "seq", "member", "wav_name")

    def extract(part: DataFrame) -> DataFrame:
        # One task reads an archive, many convert its clips.
        return convert(with_payloads(part).repartition("archive", "seq")).drop("content")

    return Extraction(convert_until(work, wanted, extract, "archive", "seq"), skipped_members(names, existing))


def engine_entries(clips: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows for imported (engine, path) clips that are not in the manifest."""
    offered = entries(
        clips.select(wav_for_engine_clip("path").alias("filename"),
                     F.col("engine").alias("voice_model"), "path"),
        FAKE, METHOD_SPEECH, generated_at=IMPORT_TIME)
    once = keep_first(offered, ["filename", "voice_model"], "path")
    return pending_by_key(once, manifest, unique=True)


def speech_plan(sentences: DataFrame, voice_label: str, manifest: DataFrame,
                limit: int | None = None, method: str | None = None) -> DataFrame:
    """Sentences to speak with one voice, in clip order, with the characters each costs (`char_stats` sums them).

    With `method` only rows of that method count as done.
    """
    work = sentences.select(
        F.col("wav_filename").alias("source_file"), "sentence", F.char_length("sentence").cast("long").alias("char_count"),
        speech_name("wav_filename", F.lit(voice_label)).alias("filename"),
        F.lit(voice_label).alias("voice_model"))
    return head_limit(pending_by_key(work, manifest, method), limit, "source_file")
