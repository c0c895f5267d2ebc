"""Tables that grow by commits: a folder for each, seen by readers from its marker on.

<root>/<table>/commit=<number>/   Parquet of one commit
<root>/_commits/<number>          its marker, written last and by renaming

A marker names the folders that make up the tables and holds whatever small
state its writer keeps, so readers and writers look at the newest one alone.  A
write that was cut short has no marker: nothing of it is read, and the next
write takes its folder.  One writer at a time.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipledger.operators.ordering import keep_last
from clipledger.sources.folders import delete, file_names, read_text, write_text

FAN = 16   # commits of one level and stream that are folded into one of the next level


class Commit(NamedTuple):
    number: int
    level: int           # 0 as committed; one more each time it was folded
    stream: str | None   # the stream whose batch it is


class Marker(NamedTuple):
    number: int
    live: list[Commit]
    streams: dict[str, int]   # newest batch of every stream
    state: dict


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, table: str, number: int) -> str:
        return f"{self.root}/{table}/commit={number:08d}"

    def newest(self) -> Marker:
        names = [n for n in file_names(self.spark, f"{self.root}/_commits") if n.isdigit()]
        if not names:
            return Marker(-1, [], {}, {})
        held = json.loads(read_text(self.spark, f"{self.root}/_commits/{max(names)}"))
        return Marker(int(max(names)), [Commit(*c) for c in held["live"]], held["streams"], held["state"])

    def has(self, stream: str, batch: int) -> bool:
        """Whether that batch of the stream is committed; its batches come in order."""
        return self.newest().streams.get(stream, -1) >= batch

    def read(self, table: str, schema: str | T.StructType, commits: list[Commit] | None = None) -> DataFrame:
        """The rows of all commits, or of some."""
        return self._numbered(table, schema, self.newest().live if commits is None else commits).drop("commit")

    def _numbered(self, table: str, schema: str | T.StructType, live: list[Commit]) -> DataFrame:
        """The rows with the number of their commit."""
        if not live:
            return self.spark.createDataFrame([], schema).withColumn("commit", F.lit(0))
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(
            *[self._path(table, c.number) for c in live])

    def latest(self, table: str, schema: str | T.StructType, key: str, commits: list[Commit] | None = None) -> DataFrame:
        """The newest row of each key."""
        rows = self._numbered(table, schema, self.newest().live if commits is None else commits)
        return keep_last(rows, [key], "commit").drop("commit")

    def write(self, number: int, table: str, rows: DataFrame, partitions: tuple[str, ...] = ()) -> str:
        """Write a table of the commit `number`, which is not seen before `mark`; returns its folder."""
        path = self._path(table, number)
        rows.write.partitionBy(*partitions).mode("overwrite").parquet(path)
        return path

    def mark(self, before: Marker, state: dict, stream: str | None = None, batch: int = 0) -> None:
        """Make what was written as commit `before.number + 1` visible, with the new state."""
        streams = before.streams | ({stream: batch} if stream is not None else {})
        self._mark(Marker(before.number + 1, [*before.live, Commit(before.number + 1, 0, stream)], streams, state))

    def _mark(self, marker: Marker) -> None:
        write_text(self.spark, f"{self.root}/_commits/{marker.number:08d}", json.dumps(
            {"live": marker.live, "streams": marker.streams, "state": marker.state}))

    def fold(self, tables: dict[str, tuple[str | T.StructType, tuple[str, ...]]], key: str | None = None) -> None:
        """Fold the last FAN commits into one while they are of one level and stream.

        tables: schema and partition columns of each.  A row is rewritten once
        for each level, so as often as the logarithm of the commits.  Of a
        table with the column `key` only the newest row of each key is kept.
        """
        while True:
            now = self.newest()
            last = now.live[-FAN:]
            if len(last) < FAN or len({(c.level, c.stream) for c in last}) > 1:
                return
            number = now.number + 1
            for table, (schema, partitions) in tables.items():
                rows = self.read(table, schema, last)
                if key in rows.columns:
                    rows = self.latest(table, schema, key, last)
                self.write(number, table, rows, partitions)
            self._mark(now._replace(number=number, live=[
                *now.live[:-FAN], Commit(number, last[0].level + 1, last[0].stream)]))

    def vacuum(self, *tables: str) -> None:
        """Delete folders and markers that the newest marker does not name; for when nothing reads them."""
        now = self.newest()
        named = {c.number for c in now.live}
        for number in range(now.number + 1):
            if number not in named:
                for table in tables:
                    delete(self.spark, self._path(table, number))
            if number < now.number:
                delete(self.spark, f"{self.root}/_commits/{number:08d}")
