"""Expressions and joins that the operators of this subpackage share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of the contracts, as regular expression and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter unchanged."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    bare = stripped(text)
    return F.when(F.coalesce(F.char_length(bare), F.lit(0)) == 0, F.array().cast("array<string>")
                  ).otherwise(F.split(bare, SPACE + "+"))


def carried(columns: tuple[str, ...]) -> Column:
    """Columns that pass through an operator, in one struct so that no name can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in columns], F.lit(None).cast("int").alias("__none")).alias("carried")


def held_out(doc_id: Column, folds: int) -> Column:
    """Rows that nothing is learned from, one in `folds` by a checksum of the id; null ids too."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(True))


def row_key(*columns: Column) -> list[Column]:
    """128 bits that name a row, also where its identifier is null or repeated."""
    return [F.xxhash64(*columns).alias("__k1"), F.xxhash64(F.lit(7), *reversed(columns)).alias("__k2")]


def lookup_counted(left: DataFrame, right: DataFrame, key: str, rows: str,
                   values: list[str], spread: Column) -> DataFrame:
    """Add `values` of the `right` row with the same `key`; null where there is none.

    right: a stored table with one row per key and in `rows` how many rows of
    `left` have it.  Keys with more rows than half a partition, so at most
    twice as many keys as partitions, are met by broadcast; their rows are
    dealt out by `spread` in the join of all others.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    limit = max(total // (2 * partitions(left)), 1)
    names = {v: f"__v_{v}" for v in values}
    hot = right.where(F.col(rows) > limit).select(
        F.col(key).alias("__hot"), *[F.col(v).alias(f"__h_{v}") for v in values])
    cold = right.where(F.col(rows) <= limit).select(
        F.col(key).alias("__cold"), *[F.col(v).alias(n) for v, n in names.items()])
    met = left.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").withColumn(
        "__meet", F.when(F.col("__hot").isNull(), F.col(key)).otherwise(spread))
    return met.join(cold, F.col("__meet") == F.col("__cold"), "left").select(
        *left.columns, *[F.coalesce(f"__h_{v}", n).alias(v) for v, n in names.items()])
