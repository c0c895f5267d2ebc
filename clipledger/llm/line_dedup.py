"""Lines that many documents share are dropped from all of them.

Normalised lines are hashed (128 bits) and exploded, documents are counted per
hash, and the positions of the lines to drop go back to their documents.  Only
hashes and positions travel per line; a text is shuffled once, to meet its
positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.common import ascii_lower, carried, lookup_counted, row_key, stripped
from clipledger.session import stored


def _line_key(line):
    """Null for lines without a key."""
    key = ascii_lower(stripped(line))
    return F.when(F.char_length(key) > 0, F.md5(key))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_text, and the struct `carried` of other columns.

    A line goes where its key (stripped, A-Z lower-cased, not empty) is found
    in at least `min_docs` rows.  Every row counts as a document, repeated rows
    and null identifiers too.  A null or empty text is one empty line, which
    has no key and stays.  Columns outside `carry` are not read; an empty table
    gives an empty result.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       carried(carry))
    keyed = rows.select(*row_key(F.col("doc_id"), F.col("text")),
                        F.transform(F.split("text", "\n"), _line_key).alias("keys"))
    common = stored(
        # Outer, as a filter on the array would be put before it and hash all lines once more.
        keyed.select(F.explode_outer(F.array_distinct("keys")).alias("key")).where("key is not null")
        .groupBy("key").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs)
        .withColumn("common", F.lit(True)),
        "common-lines")
    places = keyed.select("__k1", "__k2", F.posexplode_outer("keys").alias("pos", "key")).where("key is not null")
    dropped = (
        lookup_counted(places, common, "key", "n_docs", ["common"],
                       F.concat(F.lit("~"), F.xxhash64("__k1", "pos").cast("string")))
        .where("common").groupBy("__k1", "__k2").agg(F.collect_set("pos").alias("drop")))
    whole = rows.select("*", *row_key(F.col("doc_id"), F.col("text"))).join(
        dropped, ["__k1", "__k2"], "left")
    lines = whole.select("doc_id", "carried", F.col("text"), F.split("text", "\n").alias("lines"), "drop")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    return lines.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")).alias("kept_text"), "carried")
