"""Budgeted conversion in flushes; what was used is kept with every commit of outcomes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipledger.functions.fields import entries, utc_stamp
from clipledger.functions.paths import revoiced_label
from clipledger.operators.ordering import global_position, keep_first
from clipledger.operators.pending import set_difference
from clipledger.plans.revoicing import convert_within, revoicing_work
from clipledger.schema import BUDGET_FLOOR_MS, FAKE, METHOD_REVOICED
from clipledger.sources.commits import CommitLog
from clipledger.sources.store import LedgerStore
from clipledger.streaming.ingest import seeded_at, stream_id
from clipledger.streaming.seen import drain, first_seen, keyed_state

# A row without source_file marks that the budget stopped the voice in that run.
OUTCOMES = ("run string, voice string, voice_model string, source_file string, "
            "filename string, duration_ms bigint, error string")
_COLUMNS = [c.split()[0] for c in OUTCOMES.split(", ")]

Convert = Callable[[DataFrame], DataFrame]


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return CommitLog(spark, path).read("outcomes", OUTCOMES)


def _tried(outcomes: DataFrame, run: str, voice: str) -> DataFrame:
    return outcomes.where((F.col("run") == run) & (F.col("voice") == voice) & F.col("source_file").isNotNull())


def _used(store: LedgerStore, voice: str) -> DataFrame:
    """Sources that the ledger has for the voice."""
    label = revoiced_label(F.lit(voice))
    return store.read().where((F.col("voice_model") == label) & (F.coalesce("source_file", F.lit("")) != ""))


def convert_batch(batch: DataFrame, store: LedgerStore, outcomes_path: str, run: str, voice: str,
                  limit_ms: int, convert: Convert, at: Column | None = None) -> None:
    """Convert the sources of `batch` that the run has not tried for `voice` and the ledger does not have.

    Both are told by reading the log and the ledger; a stream keeps that as state instead.
    """
    tried = _tried(read_outcomes(store.spark, outcomes_path), run, voice)
    once = keep_first(batch, ["source_file"], "duration_ms")
    _flush(set_difference(once, tried, "source_file", unique=True), store, outcomes_path, run, voice, limit_ms,
           convert, at)


def _flush(fresh: DataFrame, store: LedgerStore, outcomes_path: str, run: str, voice: str, limit_ms: int,
           convert: Convert, at: Column | None, stream: str | None = None, batch: int = 0,
           used: DataFrame | None = None) -> None:
    """Convert one flush of sources with what the run has left.

    A voice begins only with BUDGET_FLOOR_MS left; once it has begun, only a
    source that does not fit ends it, so the answer does not depend on how the
    sources are cut into flushes.  The outcomes are committed first, with the
    budget as it then is; the ledger follows, and is mended by a replay.
    """
    log = CommitLog(store.spark, outcomes_path)
    _register(store, log, at)   # what a flush that was cut short left behind
    before = log.newest()
    if stream is not None and before.streams.get(stream, -1) >= batch:
        drain(fresh)
    else:
        runs = before.state.get("runs", {})
        now = runs.get(run, {"used": 0, "voices": {}})
        mine = now["voices"].get(voice)   # None, begun or stopped
        left = limit_ms - now["used"]
        stop = store.spark.createDataFrame([(run, voice, None, None, None, None, "budget")], OUTCOMES)
        rows, spent = stop.limit(0), 0
        if mine == "stopped":
            drain(fresh)
        elif mine is None and left < BUDGET_FLOOR_MS:
            drain(fresh)
            mine, rows = "stopped", stop
        else:
            work = revoicing_work(fresh, voice, _used(store, voice) if used is None else used)
            done, spent, stopped = convert_within(work, left, convert)
            rows = done.withColumn("run", F.lit(run)).select(_COLUMNS)
            # A voice has begun with its first source.
            mine = "stopped" if stopped else "begun" if mine or not done.isEmpty() else None
            rows = rows.unionByName(stop) if stopped else rows
        voices = now["voices"] | ({voice: mine} if mine else {})
        log.write(before.number + 1, "outcomes", rows.select(_COLUMNS))
        log.mark(before, {"runs": runs | {run: {"used": now["used"] + spent, "voices": voices}}}, stream, batch)
        _register(store, log, at)
    log.fold({"outcomes": (OUTCOMES, ())})


def _register(store: LedgerStore, log: CommitLog, at: Column | None) -> None:
    """Append the successes of the newest commit of outcomes, unless the ledger has them."""
    newest = log.newest()
    if not newest.live or newest.live[-1].level:   # commits are folded when the ledger has them
        return
    last = newest.live[-1]
    name, number = (f"outcomes:{log.root}", last.number) if last.stream is None else (
        last.stream, newest.streams[last.stream])
    if store.has(name, number):
        return
    good = log.read("outcomes", OUTCOMES, [last]).where(
        F.col("error").isNull() & F.col("source_file").isNotNull())
    rows = entries(good.select("filename", "voice_model", "source_file"), FAKE, METHOD_REVOICED,
                   generated_at=utc_stamp(at))
    store.append(global_position(rows, "voice_model", "source_file", name="entry_seq",
                                 start=store.state()["next_seq"]), name, number)


def convert_stream(sources: DataFrame, store: LedgerStore, outcomes_path: str, progress: str,
                   run: str, voice: str, limit_ms: int, convert: Convert,
                   at: Column | None = None) -> StreamingQuery:
    """Start one voice over the sources there are now; voices run one after another.

    sources: source_file, duration_ms and `arrival` as `arriving` gives it.
    Which sources the run has tried and the ledger has is keyed state, told at
    the first start; flushes read neither the log nor the ledger, unless
    somebody else wrote to the ledger.  Outcomes are exactly once.
    """
    since = seeded_at(store, progress)
    known = _tried(read_outcomes(store.spark, outcomes_path), run, voice).select("source_file").unionByName(
        _used(store, voice).select("source_file"))
    fresh = first_seen(sources.where("source_file is not null"), "source_file", known)
    none = store.spark.createDataFrame([], "voice_model string, source_file string, method string")

    def flush(batch: DataFrame, number: int) -> None:
        stream = stream_id(batch.sparkSession, progress)
        others = store.added_since(since, stream)
        _flush(batch, store, outcomes_path, run, voice, limit_ms, convert, at, stream, number,
               none if others is None else others)

    with keyed_state(store.spark):
        return (
            fresh.writeStream.foreachBatch(flush)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
