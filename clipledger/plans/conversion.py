"""Assign clips to voices, convert what is pending, merge the outcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipledger.functions.fields import utc_stamp
from clipledger.operators.assign import assign
from clipledger.operators.merge import incoming_entries, manifest_merge, merge_rows
from clipledger.operators.outcomes import convert_rows, successes
from clipledger.operators.pending import limit_per_voice, pending_by_output
from clipledger.schema import TEST_LIMIT
from clipledger.session import stored


def job_limit(limit: int | None, full: bool) -> int | None:
    """An explicit limit wins, then `full`; a trial run takes a few per voice."""
    if limit is not None:
        return limit
    return None if full else TEST_LIMIT


def conversion_plan(clips: DataFrame, voices: DataFrame, outputs: DataFrame, fake_root: str,
                    strategy: str = "stratified", voice: str | None = None,
                    limit: int | None = None) -> DataFrame:
    """Clips to convert: (voice, source_path, filename, target_path, ...).

    Finished work is removed before the limit is applied, per voice.
    """
    work = assign(clips.withColumnRenamed("path", "source_path"), voices, strategy, voice)
    return limit_per_voice(pending_by_output(work, outputs, fake_root), limit, "source_path")


def run_conversion(plan: DataFrame, convert: Callable[[object, dict], dict],
                   setup: Callable[[], object] | None = None) -> DataFrame:
    """Outcomes of the plan, stored, so that no clip is converted twice."""
    added = T.StructType([T.StructField("elapsed_ms", T.LongType())])
    return stored(convert_rows(plan, convert, added, setup), "outcomes")


def merged_manifest(manifest: DataFrame, clips: DataFrame, outcomes: DataFrame, method: str,
                    at: Column | None = None, params: dict | None = None) -> DataFrame:
    """The whole ledger after the run; `appended_entries` has its new rows alone."""
    return manifest_merge(manifest, _offered(clips, outcomes, method, at, params), "part", "ord", "origin")


def appended_entries(manifest: DataFrame, clips: DataFrame, outcomes: DataFrame, method: str,
                     at: Column | None = None, params: dict | None = None) -> DataFrame:
    """The rows a run adds to the ledger, for `LedgerStore.append`."""
    return merge_rows(manifest, _offered(clips, outcomes, method, at, params), "part", "ord", "origin")


def _offered(clips, outcomes, method, at, params) -> DataFrame:
    return incoming_entries(clips, successes(outcomes), method, utc_stamp(at), params)
