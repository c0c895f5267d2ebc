"""Resumable sample ingest: micro-batches appended to the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipledger.functions.fields import utc_stamp
from clipledger.operators.pending import set_difference
from clipledger.plans.corpus import new_samples, sample_entries
from clipledger.schema import METHOD_SAMPLES
from clipledger.session import stored
from clipledger.sources.folders import exists, read_text, write_text
from clipledger.sources.store import LedgerStore
from clipledger.streaming.seen import ARRIVAL, drain, first_seen, keyed_state

_ORDER = "__arrival"

Prepare = Callable[[DataFrame], DataFrame]


def ingest_batch(batch: DataFrame, store: LedgerStore, target: int | None, prepare: Prepare | None = None,
                 at: Column | None = None) -> None:
    """Append the new successes of one batch in arrival order, up to the target (None: all).

    `batch` has source_file and what `prepare` needs to add `error`.  What is
    new is told by the whole ledger; a stream keeps that as state instead.
    """
    if _wanted(store, target) <= 0:
        return
    mine = store.read().where(F.col("method") == METHOD_SAMPLES)
    fresh = new_samples(batch.withColumn(_ORDER, F.monotonically_increasing_id()), mine, _ORDER)
    _append_samples(fresh, store, target, prepare, at, [_ORDER])


def _wanted(store: LedgerStore, target: int | None) -> int:
    return (1 << 62 if target is None else target) - store.state()["samples"]


def _append_samples(fresh: DataFrame, store: LedgerStore, target: int | None, prepare: Prepare | None,
                    at: Column | None, order: list[str], stream: str | None = None, batch: int = 0) -> None:
    outcomes = prepare(fresh) if prepare else fresh.withColumn("error", F.lit(None).cast("string"))
    # Stored before it is ordered, which reads it twice: `prepare` runs once.
    outcomes = stored(outcomes.select("source_file", *order, "error"), "outcomes")
    state = store.state()
    rows = sample_entries(outcomes, 1 << 62 if target is None else target, state["samples"], state["next_index"],
                          utc_stamp(at), *order)
    store.append(rows.withColumn("entry_seq", F.col("index") - F.lit(state["next_index"]) + F.lit(state["next_seq"])),
                 stream, batch)


def stream_id(spark: SparkSession, progress: str) -> str:
    """The identifier a stream keeps in its progress folder over all its runs."""
    text = spark.read.text(f"{progress.rstrip('/')}/metadata").first()["value"]
    return text.split('"id":"')[1].split('"')[0]


def seeded_at(store: LedgerStore, progress: str) -> tuple[int, int]:
    """Where the ledger was when the keyed state of `progress` was first told what it holds."""
    path = f"{progress.rstrip('/')}/seeded"
    if not exists(store.spark, path):
        write_text(store.spark, path, "%d %d" % store.position())
    version, number = read_text(store.spark, path).split()
    return int(version), int(number)


def ingest_stream(samples: DataFrame, store: LedgerStore, progress: str, target: int | None,
                  prepare: Prepare | None = None, at: Column | None = None) -> StreamingQuery:
    """Start the ingest over all files there are now; run again to resume.

    samples: source_file, what `prepare` needs, and `arrival` as `sample_stream`
    gives it.  `progress` keeps which files were read and, as keyed state, which
    paths were seen; it must be a shared folder.  A path counts once, with the
    first sample that arrives, also where that fails: which rows are added and
    their order do not depend on how the files are cut into batches.  Batches
    are appended exactly once, and do not read the ledger unless somebody
    else wrote to it.
    """
    mine = F.col("method") == METHOD_SAMPLES
    since = seeded_at(store, progress)
    fresh = first_seen(samples, "source_file", store.read().where(mine).select("source_file"))

    def add(batch: DataFrame, number: int) -> None:
        stream = stream_id(batch.sparkSession, progress)
        if store.has(stream, number) or _wanted(store, target) <= 0:
            drain(batch)
            return
        others = store.added_since(since, stream)
        if others is not None:
            named = F.coalesce(F.col("source_file"), F.lit("")) != ""
            batch = set_difference(batch, others.where(mine & named), "source_file")
        blank = batch.withColumn("source_file", F.coalesce("source_file", F.lit("")))
        _append_samples(blank, store, target, prepare, at, list(ARRIVAL), stream, number)

    with keyed_state(store.spark):
        return (
            fresh.writeStream.foreachBatch(add)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
