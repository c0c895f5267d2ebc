"""Text tables: manifest, transcripts and sentences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions.fields import accepted, as_text, rejected, typed_or_reject
from clipledger.operators.ordering import global_position
from clipledger.schema import LEDGER, MANIFEST_FIELDS
from clipledger.sources.folders import exists

_QUOTING = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
FILE_ORDER = ["file", "block", "line"]


def _layouts(spark: SparkSession, path: str) -> dict[tuple[str, bool], list[str]]:
    """Files by their header line and by whether a quoted cell holds a line break.

    A line with an odd number of quotes opens or closes such a cell.  Files
    without one are split over tasks; one row per file comes to the driver,
    which has listed the files anyway.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.groupBy("file").agg(
        F.min(F.struct("block", "line", "value")).alias("head"), F.max(quotes % 2).alias("odd")).collect()
    out: dict[tuple[str, bool], list[str]] = {}
    for r in sorted(found, key=lambda r: r["file"]):
        out.setdefault((r["head"]["value"], bool(r["odd"])), []).append(r["file"])
    return out


def _text_tables(spark: SparkSession, path: str, **options: str) -> list[DataFrame]:
    """The files' rows with FILE_ORDER, one table for each header.

    Columns are bound by header name, file by file; a given schema, or the
    header of the first file, would bind them by position.
    """
    return [
        with_file_order(spark.read.options(
            **{**_QUOTING, "multiLine": str(broken).lower(), "inferSchema": "false", **options}).csv(files))
        for (_, broken), files in _layouts(spark, path).items()]


def _picked(spark: SparkSession, tables: list[DataFrame], columns: list[str]) -> DataFrame:
    if not tables:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    return reduce(DataFrame.unionByName, [t.select(columns) for t in tables])


def with_file_order(table: DataFrame) -> DataFrame:
    """Add file, block and line: together the order of the rows in their files."""
    return table.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def manifest_scan(spark: SparkSession, path: str,
                  **options: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of manifest files; a missing path has none.

    Accepted rows carry entry_seq, their position in the files.
    """
    if not exists(spark, path):
        empty = spark.createDataFrame([], LEDGER)
        return empty, empty.withColumn("reject", F.lit(""))
    tables = [typed_or_reject(t) for t in _text_tables(spark, path, **options)]
    columns = [*FILE_ORDER, *MANIFEST_FIELDS, "reject"]
    if not tables:
        empty = spark.createDataFrame([], LEDGER)
        return empty, empty.withColumn("reject", F.lit(""))
    typed = reduce(DataFrame.unionByName, [t.select(columns) for t in tables])
    good = global_position(accepted(typed), *FILE_ORDER, name="entry_seq")
    return good.select(LEDGER.names), rejected(typed).drop(*FILE_ORDER)


def manifest_write(manifest: DataFrame, path: str) -> None:
    """Export as a folder of CSV files in entry order, blanks for NULL."""
    ordered = manifest
    if "entry_seq" in manifest.columns:
        ordered = manifest.repartitionByRange("entry_seq").sortWithinPartitions("entry_seq")
    as_text(ordered).write.options(**_QUOTING, emptyValue="").csv(path)


def transcript_scan(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(path, sentence, file, block, line) of tab-separated transcripts."""
    return _picked(spark, _text_tables(spark, path, sep="\t", **options), ["path", "sentence", *FILE_ORDER])


def sentences_scan(spark: SparkSession, path: str) -> DataFrame:
    return _picked(spark, _text_tables(spark, path), ["wav_filename", "sentence"])


def sentences_write(sentences: DataFrame, path: str) -> None:
    """Sentences sorted by clip name, in sorted files."""
    sentences.select("wav_filename", "sentence", "char_count").repartitionByRange(
        "wav_filename").sortWithinPartitions("wav_filename").write.options(**_QUOTING).csv(path)
