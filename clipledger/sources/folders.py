"""File listings as DataFrames, and the few folder facts a plan needs."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions.paths import basename, parent_name
from clipledger.schema import ENGINE_TREE, LISTING
from clipledger.session import stored
from clipledger.sources.archives import default_file_system, located

_ARROW_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")   # what tasks can list themselves
_ENTRY_ROWS = 10_000


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def file_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: it is renamed when it is complete."""
    fs, p = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(part, p):
        raise OSError(f"could not write {path}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _entries(folders: DataFrame) -> DataFrame:
    """(path, length, is_folder) of what lies in each folder; hidden names are left out."""
    default = default_file_system(folders.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                filesystem, path = located(folder, default)
                found = [f for f in filesystem.get_file_info(arrow_fs.FileSelector(path)) if f.base_name[:1] not in "._"]
                for k in range(0, len(found), _ENTRY_ROWS):
                    part = found[k:k + _ENTRY_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{folder.rstrip('/')}/{f.base_name}" for f in part], pa.string()),
                         pa.array([f.size for f in part], pa.int64()),
                         pa.array([f.type == arrow_fs.FileType.Directory for f in part], pa.bool_())],
                        ["path", "length", "is_folder"])

    return folders.mapInArrow(run, "path string, length bigint, is_folder boolean")


def _levels(spark: SparkSession, folders: list[str], deepest: int | None = None) -> Iterator[DataFrame]:
    """The entries of the folders, of their subfolders and so on, level by level.

    The folders of a level are dealt to all tasks, and their subfolders anew on
    the next one, so a large tree is listed by all of them.  No path goes to
    the driver; one folder's own entries are held by one task.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = spark.createDataFrame([(plain_path(f),) for f in folders], "folder string")
    depth = 0
    while True:
        entries = stored(_entries(level.repartition(min(parts, len(folders)) if depth == 0 else parts)), "listing")
        yield entries
        depth += 1
        level = entries.where("is_folder").select(F.col("path").alias("folder"))
        if depth == deepest or level.isEmpty():
            return


def plain_path(path: str) -> str:
    """Without the scheme of local files, so that paths compare with the ones jobs were given."""
    return re.sub("^file:/+", "/", path).rstrip("/") or "/"


def _named(entries: DataFrame, pattern: str) -> DataFrame:
    """The files whose name fits a pattern of *, ?, [...] and {a,b}."""
    first = re.match(r"(.*?)\{([^{}]*)\}(.*)", pattern, re.DOTALL)
    patterns = [first[1] + x + first[3] for x in first[2].split(",")] if first else [pattern]
    inner = "|".join(fnmatch.translate(p).removesuffix(r"\z").removesuffix(r"\Z") for p in patterns)
    return entries.where(~F.col("is_folder") & basename("path").rlike(f"^(?:{inner})$")).select("path", "length")


def listing(spark: SparkSession, folder: str | list[str], pattern: str = "*.wav",
            recursive: bool = False) -> DataFrame:
    """(path, length) of the matching files; their content is never read.

    A folder may end in /* for all its subfolders.  Listed by tasks and stored,
    where Arrow can reach the folders; otherwise, or by another pattern, by
    Spark's own file index, which holds all paths on the driver.
    """
    folders = [folder] if isinstance(folder, str) else folder
    if len(folders) == 1 and folders[0].endswith("/*") and _reachable(folders[0][:-2]) and not recursive:
        below = list(_levels(spark, [folders[0][:-2]], 2))[1:]
        return _named(below[0], pattern) if below else spark.createDataFrame([], LISTING)
    if not all(map(_reachable, folders)):
        return _indexed(spark, folders, pattern, recursive)
    return reduce(DataFrame.unionByName, [
        _named(entries, pattern) for entries in _levels(spark, folders, None if recursive else 1)])


def _reachable(folder: str) -> bool:
    scheme = folder.partition(":")[0] if ":" in folder.partition("/")[0] else "file"
    return scheme in _ARROW_SCHEMES and not re.search(r"[*?\[{]", folder)


def _indexed(spark: SparkSession, folders: list[str], pattern: str, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folders).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def clip_listing(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """Clips of one folder, not of its subfolders: (path, length, filename).

    A missing or empty folder is an error; sort by path where order matters.
    """
    if not exists(spark, folder):
        raise FileNotFoundError(f"no such folder: {folder}")
    clips = listing(spark, folder, pattern)
    if clips.isEmpty():
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return clips.withColumn("filename", basename("path"))


def root_union(spark: SparkSession, folders: list[str], pattern: str = "*.wav") -> DataFrame:
    """Clips of several roots as one listing; roots that do not exist are left out."""
    present = [f for f in folders if exists(spark, f)]
    if not present:
        return spark.createDataFrame([], LISTING).withColumn("filename", F.lit(""))
    return listing(spark, present, pattern).withColumn("filename", basename("path"))


def default_clip(clips: DataFrame) -> Column:
    """Scalar: the first clip by path."""
    return clips.agg(F.min("path").alias("path")).scalar()


def output_listing(spark: SparkSession, fake_root: str, pattern: str = "*") -> DataFrame:
    """(voice, filename) of the outputs in each voice's folder, of any extension."""
    if not subfolders(spark, fake_root):
        return spark.createDataFrame([], "voice string, filename string")
    return listing(spark, f"{fake_root.rstrip('/')}/*", pattern).select(
        parent_name("path").alias("voice"), basename("path").alias("filename"))


def disk_inventory(spark: SparkSession, data_root: str) -> DataFrame:
    """All wav files under the root as (path relative to it, parent, name)."""
    if not _reachable(data_root):   # as the file index writes it
        fs, p = _fs(spark, data_root)
        data_root = fs.makeQualified(p).toString()
    root = plain_path(data_root) + "/"
    files = listing(spark, data_root, "*.wav", recursive=True)
    inside = F.substring(F.col("path"), F.lit(len(root) + 1), F.length("path"))
    return files.select(inside.alias("path"), parent_name("path").alias("parent"),
                        basename("path").alias("name"))


def engine_listing(spark: SparkSession, base: str, engines: list[str],
                   top: str = ENGINE_TREE) -> tuple[DataFrame, list[str]]:
    """(engine, path) of <base>/<engine>/clean/*.mp3, and the engines without a folder."""
    root = f"{base.rstrip('/')}/{top}"
    if not exists(spark, root):
        root = base.rstrip("/")
    have = [e for e in engines if exists(spark, f"{root}/{e}/clean")]
    missing = [e for e in engines if e not in have]
    if not have:
        return spark.createDataFrame([], "engine string, path string"), missing
    files = listing(spark, [f"{root}/{e}/clean" for e in have], "*.mp3")
    return files.select(
        F.regexp_extract("path", r"([^/]*)/clean/[^/]*$", 1).alias("engine"), "path"), missing
