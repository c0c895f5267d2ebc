"""Members of gzip'd tar archives as rows: spark.read.format("tar_members")."""

from __future__ import annotations

import re
import tarfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, StringEndsWith,
)

_BATCH_BYTES, _BATCH_ROWS = 16 << 20, 10_000   # payload and members handed on at a time
_BOUNDS = (EqualTo, LessThan, LessThanOrEqual, GreaterThan, GreaterThanOrEqual)
_LAST = (1 << 63) - 1
_SCHEMA = "archive string, member string, seq bigint, is_file boolean, content binary"


class _Archives(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _TarReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options["paths"].split("\n") if p]
        self.suffix = options.get("suffix", "")
        self.content = options.get("content", "true") == "true"
        self.default = options.get("default", "file:///")
        self.tasks = int(options.get("tasks", len(self.paths)))
        self.first, self.last = 0, _LAST   # wanted places in an archive

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Archives and places are pruned before anything is read; a scan ends behind its last place.

        A member's ending only spares payloads, so Spark still applies it.
        """
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("archive",) and isinstance(f, (EqualTo, In)):
                wanted = {value} if isinstance(f, EqualTo) else set(value)
                self.paths = [p for p in self.paths if p in wanted]
            elif column == ("seq",) and isinstance(f, _BOUNDS):
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.last = min(self.last, value - isinstance(f, LessThan))
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.first = max(self.first, value + isinstance(f, GreaterThan))
            else:
                if column == ("member",) and isinstance(f, StringEndsWith) and value.endswith(self.suffix):
                    self.suffix = value
                yield f

    def partitions(self) -> list[_Archives]:
        # A gzip stream cannot be entered midway, so an archive belongs to one task; a task has many if there are many.
        return [_Archives(self.paths[k::self.tasks]) for k in range(min(self.tasks, len(self.paths)))]

    def read(self, partition: _Archives | None) -> Iterator[pa.RecordBatch]:
        # Without a partition no archive is left.
        return self.batches(partition.paths if partition else [])

    def batches(self, archives: Iterable[str]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for archive in archives:
            for row in self._members(archive):
                held.append(row)
                size += len(row[4] or b"")
                if size >= _BATCH_BYTES or len(held) >= _BATCH_ROWS:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)

    def _members(self, archive: str) -> Iterator[tuple]:
        for seq, member, payload in _walk(archive, self.default, self.last):
            if seq >= self.first:
                wanted = self.content and member.isfile() and member.name.endswith(self.suffix)
                yield archive, member.name, seq, member.isfile(), payload() if wanted else None


def _walk(archive: str, default: str, last: int) -> Iterator[tuple]:
    """(place, member, reader of its payload) up to place `last`; payloads not asked for are skipped over."""
    filesystem, path = located(archive, default)
    with filesystem.open_input_stream(path, compression=None) as raw:
        with tarfile.open(fileobj=raw, mode="r|gz") as tar:
            for seq, member in enumerate(tar):
                if seq > last:
                    return
                yield seq, member, lambda member=member: tar.extractfile(member).read()
                if seq == last:
                    return


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
    names = ["archive", "member", "seq", "is_file", "content"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def as_uri(path: str, default: str = "file:///") -> str:
    """The path with its scheme; one without belongs to the file system `default`."""
    if "://" not in path and not path.startswith("file:/"):
        path = f"file://{path}" if default.startswith("file:") else default.rstrip("/") + path
    path = re.sub("^file:/+", "file:///", path)
    return path.replace("s3a://", "s3://")


def located(path: str, default: str = "file:///") -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path and the path inside it, whatever characters it has."""
    uri = as_uri(path, default)
    if uri.startswith("file://"):
        return arrow_fs.LocalFileSystem(), uri.removeprefix("file://")
    scheme, _, rest = uri.partition("://")
    host, _, inside = rest.partition("/")
    filesystem, root = arrow_fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return filesystem, f"{root.rstrip('/')}/{inside}"


def default_file_system(spark: SparkSession) -> str:
    return spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")


class TarMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> _TarReader:
        return _TarReader(self.options)


def _tasks(spark: SparkSession) -> int:
    """Tasks that archives are dealt to: enough to keep all cores busy, however many archives there are."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def archive_members(spark: SparkSession, archives: list[str] | DataFrame, suffix: str = "",
                    content: bool = True) -> DataFrame:
    """Every member of the archives; payloads only of files ending in `suffix`.

    An archive is read by one task, so spread the rows before heavy work.  Of a
    list, filters on archive and seq prune the scan.  A table names archives by
    `path`; none of them goes to the driver, so there may be any number.
    """
    options = {"suffix": suffix, "content": str(content).lower(), "default": default_file_system(spark)}
    if isinstance(archives, DataFrame):
        reader = _TarReader({"paths": "", **options})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return reader.batches(path for batch in batches for path in batch.column(0).to_pylist())

        return archives.select("path").repartition(_tasks(spark)).mapInArrow(run, _SCHEMA)
    spark.dataSource.register(TarMembers)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tar_members").options(
        paths="\n".join(archives), tasks=str(_tasks(spark)), **options).load()


def with_payloads(wanted: DataFrame) -> DataFrame:
    """Add `content` to members given by archive and seq; a member that is not there gets none.

    Each archive is read once, by one task, up to its last wanted member; only
    the wanted payloads are handed on.
    """
    default = default_file_system(wanted.sparkSession)
    schema = T.StructType([*wanted.schema.fields, T.StructField("content", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by("seq")
        places = rows.column("seq").to_numpy()
        archive = rows.column("archive")[0].as_py()
        held: list[tuple[int, bytes | None]] = []
        size = at = 0
        for seq, member, payload in _walk(archive, default, int(places[-1])):
            end = int(np.searchsorted(places, seq, side="right"))
            if end > at:
                content = payload() if member.isfile() else None
                held += [(i, content) for i in range(at, end)]
                size, at = size + len(content or b""), end
            if size >= _BATCH_BYTES or len(held) >= _BATCH_ROWS:
                yield _with_content(rows, held)
                held, size = [], 0
        held += [(i, None) for i in range(at, len(places))]
        if held:
            yield _with_content(rows, held)

    # The rows are small whatever the archives hold, so their size must not decide on the number of tasks.
    return wanted.repartition(_tasks(wanted.sparkSession), "archive").groupBy("archive").applyInArrow(read, schema)


def _with_content(rows: pa.Table, held: list[tuple[int, bytes | None]]) -> pa.RecordBatch:
    picked = rows.take(pa.array([i for i, _ in held], pa.int64())).combine_chunks().to_batches()[0]
    return pa.RecordBatch.from_arrays(
        [*picked.columns, pa.array([c for _, c in held], pa.binary())], [*picked.schema.names, "content"])
