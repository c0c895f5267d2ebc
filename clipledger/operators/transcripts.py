"""Sentences for the real clips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.functions.paths import wav_for_transcript
from clipledger.functions.text import char_count, clean_sentence
from clipledger.operators.ordering import keep_last
from clipledger.operators.pending import distinct_keys, set_intersection


def match_transcripts(transcripts: DataFrame, clips: DataFrame, *order: str) -> DataFrame:
    """(wav_filename, sentence, char_count) of the clips that have a sentence.

    Blank sentences do not count; the last one per name wins.  Sentences of
    other clips go first, then the names share the shuffle of the join.
    """
    spoken = transcripts.select(
        wav_for_transcript("path").alias("wav_filename"),
        clean_sentence(F.col("sentence")).alias("sentence"), *order,
    ).where(F.col("sentence") != "")
    names = clips.select(F.col("filename").alias("wav_filename"))
    wanted = set_intersection(spoken, names, "wav_filename")
    return keep_last(wanted, ["wav_filename"], *order).select(
        "wav_filename", "sentence", char_count(F.col("sentence")).alias("char_count"))


def unmatched_clips(clips: DataFrame, sentences: DataFrame) -> DataFrame:
    return distinct_keys(clips, "filename").join(
        sentences.select(F.col("wav_filename").alias("filename")), "filename", "left_anti")
