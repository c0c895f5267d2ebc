"""Converting sources voice by voice under a shared minute budget."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.functions.paths import revoiced_label, revoiced_name
from clipledger.operators.budget import budget_plan, budget_used
from clipledger.operators.pending import pending_by_source
from clipledger.schema import BUDGET_FLOOR_MS
from clipledger.session import stored


def revoicing_work(sources: DataFrame, voice: str, manifest: DataFrame) -> DataFrame:
    """Sources (source_file, duration_ms) not used yet for the voice."""
    work = sources.select(
        "source_file", "duration_ms", F.lit(0).cast("bigint").alias("ord"),
        F.lit(voice).alias("voice"), revoiced_label(F.lit(voice)).alias("voice_model"),
        revoiced_name("source_file", F.lit(voice)).alias("filename"))
    return pending_by_source(work, manifest)


def convert_within(work: DataFrame, limit_ms: int,
                   convert: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int, bool]:
    """(outcomes, used ms, stopped) of one voice's work under what is left.

    `convert` adds `error`.  Rows are admitted as if all succeed; failures cost
    nothing, so what they leave admits further rows until one does not fit.
    """
    rest = stored(work, "work")
    outcomes, used = None, 0
    while True:
        admitted = budget_plan(rest, limit_ms - used, "source_file", floor_ms=0)
        done = stored(convert(admitted.drop("error", "used_before_ms")), "converted")
        outcomes = done if outcomes is None else outcomes.unionByName(done)
        spent = budget_used(done).first()
        used += spent["used_ms"]
        rest = stored(rest.join(done.select("source_file"), "source_file", "left_anti"), "work")
        if rest.isEmpty():
            return outcomes, used, False
        if spent["errors"] == 0:
            return outcomes, used, True


def run_revoicing(sources: DataFrame, voices: list[str], manifest: DataFrame, limit_ms: int,
                  convert: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame | None, int]:
    """Outcomes over the listed voices in turn, and the budget used."""
    outcomes, used = None, 0
    for voice in voices:
        if limit_ms - used < BUDGET_FLOOR_MS:
            break
        work = revoicing_work(sources, voice, manifest)
        done, spent, _ = convert_within(work, limit_ms - used, convert)
        outcomes = done if outcomes is None else outcomes.unionByName(done)
        used += spent
    return outcomes, used
