"""Joining many rows with a table that has one row per key, hot keys included.

A side that was just reduced to unique keys is an aggregate, and the adaptive
skew join only splits sides that come straight from a shuffle.  So keys that
hold a large share of the rows are found first and met by broadcast; their
rows never move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_BYTES = 256 << 20   # no key of a table this small needs care
_TRACKED = 8              # items the sketch follows for each key it may report
_MOST_KEYS = 100_000      # keys the sketch can report


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_hashes(df: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that hold too many rows for one task; mostly none.

    A key is hot from half the rows of an average partition on, so at most
    twice as many numbers as partitions come back.  One pass over the key
    columns with a frequent-items sketch of that size.
    """
    if _estimated_bytes(df) <= SMALL_BYTES:
        return []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(2 * parts, _MOST_KEYS)
    seen = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(h, {most}, {_TRACKED * most})").alias("top"),
    ).first()
    least = seen["rows"] / (2 * parts)
    return [t["item"] for t in seen["top"] or [] if t["count"] > least]


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join (inner, left, left_semi or left_anti) with at most one `right` row per key."""
    hot = hot_hashes(left, keys)
    if not hot:
        return left.join(right, keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    # At most one row per hot key, so no more rows than twice the partitions.
    few = F.broadcast(right.where(is_hot))
    cold = left.where(~is_hot).join(right.where(~is_hot), keys, how)
    return cold.unionByName(left.where(is_hot).join(few, keys, how))
