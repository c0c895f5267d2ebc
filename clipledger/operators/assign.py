"""Assigning clips to voices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.operators.ordering import global_position

BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side whose row count is known and small; else let it shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _voice_total(voices: DataFrame) -> int:
    total = voices.count()
    if total == 0:
        raise ValueError("no voice to assign to")
    return total


def _in_turn(voices: DataFrame) -> DataFrame:
    """Voices with `ord` 0 ... N-1 in the order of the `ord` they came with."""
    return global_position(voices, "ord", "voice", name="__turn").drop("ord").withColumnRenamed(
        "__turn", "ord")


def assign_cross(clips: DataFrame, voices: DataFrame) -> DataFrame:
    """Every voice for every clip: voices N x clips M rows, as the strategy says.

    Each clip is fanned out over the N voice numbers and meets its voices by
    equality, so any number of voices works.
    """
    total = _voice_total(voices)
    fanned = clips.withColumn("ord", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                          F.lit(total - 1).cast("bigint"))))
    return fanned.join(broadcast_if_small(_in_turn(voices), total), "ord")


def assign_stratified(clips: DataFrame, voices: DataFrame, *order: str) -> DataFrame:
    """Clip i in order goes to voice i mod N; the shares do not overlap."""
    total = _voice_total(voices)
    placed = global_position(clips, *order)
    return placed.withColumn("ord", F.col("pos") % total).join(
        broadcast_if_small(_in_turn(voices), total), "ord")


def assign(clips: DataFrame, voices: DataFrame, strategy: str = "stratified",
           voice: str | None = None) -> DataFrame:
    """Naming one voice means all clips for that voice.

    Clips are dealt by source_path where they have one: it identifies a clip,
    while copies in several folders share a filename.
    """
    if voice is not None:
        one = voices.where(F.col("voice") == voice).withColumn("ord", F.lit(0).cast("bigint"))
        return assign_cross(clips, one)
    if strategy == "cross":
        return assign_cross(clips, voices)
    if strategy == "stratified":
        return assign_stratified(
            clips, voices, "source_path" if "source_path" in clips.columns else "filename")
    raise ValueError(f"unknown strategy {strategy!r}")
