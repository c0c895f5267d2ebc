"""The ledger as Parquet: appends to the newest version, rewrites as a new one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions.paths import sequence_index
from clipledger.operators.ordering import keep_last
from clipledger.operators.outcomes import error_log
from clipledger.schema import LEDGER, METHOD_SAMPLES
from clipledger.session import stored
from clipledger.sources.commits import Commit, CommitLog, Marker
from clipledger.sources.folders import subfolders

# Pruned by the counts and anti-joins that ask for one label or method.
_PARTS = ("label", "method")
_COUNTS = "label string, method string, voice_model string, entries bigint, last_seq bigint, last_index bigint"
_TABLES = {"rows": (LEDGER, _PARTS), "counts": (_COUNTS, ())}
_CHANGES = {"rows": (LEDGER, ()), "counts": (_COUNTS, ())}
_NOTHING = {"next_seq": 0, "samples": 0, "next_index": 0}
_REWRITE_AT = 4   # the ledger is rewritten when more than one change was made for so many entries


class LedgerStore:
    """Versions v00000001, v00000002, ... below one root, each a log of commits.

    Readers take the newest version with a commit, and of it what is
    committed, so neither a failed rewrite nor half an append is ever seen.
    Every commit keeps its counts by label, method and voice, and the markers
    keep the next numbers, so appending and counting do not read the ledger.

    Changed entries are a second log of the version: readers put the newest row
    of a changed entry in the place of the old one.  When they are a good part
    of the ledger, it is rewritten.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, version: int) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/v{version:08d}")

    def _newest(self) -> tuple[int, Marker]:
        """The newest version with a commit and its marker; version 0 where there is none."""
        for name in sorted((v for v in subfolders(self.spark, self.root) if v[:1] == "v"), reverse=True):
            marker = self._log(int(name[1:])).newest()
            if marker.live:
                return int(name[1:]), marker
        return 0, Marker(-1, [], {}, {})

    def version(self) -> int:
        return self._newest()[0]

    def position(self) -> tuple[int, int]:
        """Version and newest commit: grows with every write."""
        version, marker = self._newest()
        return version, marker.number

    def _changed(self, version: int) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/v{version:08d}/changed")

    def _rows(self, version: int, commits: list[Commit]) -> DataFrame:
        if not commits:
            return self.spark.createDataFrame([], LEDGER)
        return _blank(self._log(version).read("rows", LEDGER, commits))

    def read(self) -> DataFrame:
        version, marker = self._newest()
        rows = self._rows(version, marker.live)
        changes = self._changed(version).newest()
        if not changes.live:
            return rows
        new = _blank(self._changed(version).latest("rows", LEDGER, "entry_seq", changes.live))
        # Far fewer rows than the ledger has, and one for each entry.
        return rows.join(new.select("entry_seq"), "entry_seq", "left_anti").select(LEDGER.names).unionByName(new)

    def added_since(self, position: tuple[int, int], stream: str) -> DataFrame | None:
        """Rows that others than `stream` may have added since `position`; None if there are none.

        After a rewrite that is every row.
        """
        version, marker = self._newest()
        since = position[1] if position[0] == version else -1
        others = [c for c in marker.live if c.number > since and c.stream != stream]
        return self._rows(version, others) if others else None

    def counts(self, *by: str) -> DataFrame:
        """Entries by some of label, method and voice_model, from the counts of the commits."""
        version, marker = self._newest()
        kept = self._log(version).read("counts", _COUNTS, marker.live).unionByName(
            self._changed(version).read("counts", _COUNTS))
        summed = kept.groupBy(*by).agg(F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"))
        return summed.where("entries <> 0") if by else summed

    def state(self) -> dict:
        """next_seq, samples (how many there are) and next_index (of the next sample's name)."""
        version, marker = self._newest()
        kept, changed = _NOTHING | marker.state, _NOTHING | self._changed(version).newest().state
        return {"next_seq": kept["next_seq"], "samples": kept["samples"] + changed["samples"],
                "next_index": max(kept["next_index"], changed["next_index"])}

    def _write(self, version: int, before: Marker, rows: DataFrame, state: dict,
               stream: str | None = None, batch: int = 0) -> None:
        log, number = self._log(version), before.number + 1
        path = log.write(number, "rows", rows.select(LEDGER.names), _PARTS)
        log.write(number, "counts", _counted(self.spark.read.schema(LEDGER).parquet(path)))
        log.mark(before, _added(state, log.read("counts", _COUNTS, [Commit(number, 0, stream)])), stream, batch)
        log.fold(_TABLES)

    def change(self, rows: DataFrame) -> None:
        """Put `rows` in the place of the entries with their entry_seq, all or none; others are not read or written.

        Rows of entries that the ledger does not have are left out; of several
        rows for an entry any one is taken.
        """
        version, marker = self._newest()
        log = self._changed(version)
        before = log.newest()
        number = before.number + 1
        new = keep_last(rows.select(LEDGER.names), ["entry_seq"], "filename")
        old = stored(self.read().join(new.select("entry_seq"), "entry_seq", "left_semi").select(LEDGER.names), "changed")
        path = log.write(number, "rows", new.join(old.select("entry_seq"), "entry_seq", "left_semi").select(LEDGER.names))
        less = _counted(old).withColumns({"entries": -F.col("entries"), "last_seq": F.lit(None), "last_index": F.lit(None)})
        log.write(number, "counts", _counted(self.spark.read.schema(LEDGER).parquet(path)).unionByName(less))
        state = _added(_NOTHING | before.state, log.read("counts", _COUNTS, [Commit(number, 0, None)]))
        held = state["changed"] = before.state.get("changed", 0) + old.count()
        log.mark(before, state)
        log.fold(_CHANGES, "entry_seq")
        if held * _REWRITE_AT > self.counts().first()["entries"]:
            self.rewrite(self.read())

    def append(self, rows: DataFrame, stream: str | None = None, batch: int = 0) -> None:
        """Append rows, all or none; those of one batch of a stream once, however often this is called."""
        version, before = self._newest()
        if stream is not None and before.streams.get(stream, -1) >= batch:
            return
        self._write(max(version, 1), before, rows, _NOTHING | before.state, stream, batch)

    def has(self, stream: str, batch: int) -> bool:
        return self._newest()[1].streams.get(stream, -1) >= batch

    def rewrite(self, rows: DataFrame) -> None:
        """Replace all rows; which batches are in it stays known."""
        version, before = self._newest()
        # Numbers start anew: the folder may hold what an earlier failed attempt left.
        self._write(version + 1, Marker(-1, [], before.streams, {}), rows, _NOTHING)


def _blank(rows: DataFrame) -> DataFrame:
    """A blank partition value comes back as NULL."""
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in _PARTS}).select(LEDGER.names)


def _counted(rows: DataFrame) -> DataFrame:
    blank = {c: F.coalesce(c, F.lit("")) for c in (*_PARTS, "voice_model")}
    return rows.withColumns(blank).groupBy(*blank).agg(
        F.count(F.lit(1)).alias("entries"), F.max("entry_seq").alias("last_seq"),
        F.max(F.when(F.col("method") == METHOD_SAMPLES, sequence_index("filename"))).alias("last_index"))


def _added(state: dict, counts: DataFrame) -> dict:
    """The state after rows with these counts were added; some may be negative."""
    new = counts.agg(
        F.max("last_seq").alias("seq"), F.max("last_index").alias("index"),
        F.sum(F.when(F.col("method") == METHOD_SAMPLES, F.col("entries"))).alias("samples")).first()
    return {"next_seq": max(state["next_seq"], -1 if new["seq"] is None else new["seq"] + 1),
            "samples": state["samples"] + (new["samples"] or 0),
            "next_index": max(state["next_index"], -1 if new["index"] is None else new["index"] + 1)}


class ErrorTable:
    """What failed, as a log of commits: voice, filename, error, at and the line a text log would show."""

    _SCHEMA = "voice string, filename string, error string, at string, line string"

    def __init__(self, spark: SparkSession, root: str):
        self._log = CommitLog(spark, root)

    def append(self, outcomes: DataFrame, at: Column, stream: str | None = None, batch: int = 0) -> None:
        """Append the failures among outcomes; those of one batch of a stream once."""
        if stream is not None and self._log.has(stream, batch):
            return
        before = self._log.newest()
        self._log.write(before.number + 1, "errors", error_log(outcomes, at))
        self._log.mark(before, before.state, stream, batch)
        self._log.fold({"errors": (self._SCHEMA, ())})

    def read(self) -> DataFrame:
        return self._log.read("errors", self._SCHEMA)
