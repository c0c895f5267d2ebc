"""Batches of texts of like length, with as little padding as possible.

The histogram of lengths over the whole table, one entry for each length there
is, goes to the driver; dynamic programming over it picks the bucket bounds
with the least padding.  Inside a bucket, rows are numbered without a one-task
window and cut into batches within the token budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.llm.common import words
from clipledger.operators.ordering import global_position

BUCKETS = 16
BUDGET = 65_536      # tokens of a batch, padding included


def length_class(length: Column, exact: int | None = None) -> Column:
    """The length itself; with `exact`, lengths above it share a class with those less than one part in so many off."""
    if exact is None:
        return length.cast("long")
    step = F.pow(F.lit(2), F.greatest(F.ceil(F.log2(F.greatest(length, F.lit(1)) / exact)), F.lit(0))).cast("long")
    return (F.ceil(length / step) * step).cast("long")


def bounds(histogram: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most `buckets` buckets that waste the least padding.

    histogram: (length, rows), any order.  cost(i, j) = length[j] * rows - tokens over entries i..j, so for a
    given j the best i minimises a line in length[j]; lengths grow, and a lower hull of the lines is walked once.
    """
    entries = sorted((n, c) for n, c in histogram if c)
    if not entries:
        return []
    rows, tokens = [0], [0]
    for n, c in entries:
        rows.append(rows[-1] + c)
        tokens.append(tokens[-1] + n * c)
    size = len(entries)
    best = [0] + [None] * size
    choices = []
    for _ in range(min(buckets, size)):
        hull: list[tuple[int, int, int]] = []   # slope, height, i
        now, choice, at = [None] * (size + 1), [0] * (size + 1), 0
        for j in range(1, size + 1):
            if best[j - 1] is not None:
                slope, height = -rows[j - 1], best[j - 1] + tokens[j - 1]
                while len(hull) > 1 and (height - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (
                        hull[-1][1] - hull[-2][1]) * (hull[-2][0] - slope):
                    hull.pop()
                hull.append((slope, height, j - 1))
            if not hull:
                continue
            at = min(at, len(hull) - 1)
            length = entries[j - 1][0]
            while at + 1 < len(hull) and hull[at + 1][0] * length + hull[at + 1][1] <= hull[at][0] * length + hull[at][1]:
                at += 1
            slope, height, i = hull[at]
            now[j], choice[j] = slope * length + height + length * rows[j] - tokens[j], i
        choices.append(choice)
        best = now
    found, j = [], size
    for choice in reversed(choices):
        if j:
            found.append(entries[j - 1][0])
            j = choice[j]
    return sorted(found)


def pack_lengths(docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS,
                 budget: int = BUDGET, exact: int | None = None) -> DataFrame:
    """Per row: doc_id, length, bucket, padded (the bucket's length), batch and slot (place in the batch).

    length: tokens of a row, by default its words; null counts as 0.  A bucket
    pads to the longest length it holds.  `exact` bounds the histogram, for lengths of
    millions: it has one entry for each class of length_class.  Batches are
    numbered from 0 over all buckets; each has the most rows that fit the
    budget at its padded length, the last of a bucket fewer, and one row where
    a single row is over the budget.  Rows of a bucket go in the order of
    doc_id, null first; repeated rows get slots of their own.  Other columns
    are not read; an empty table gives an empty result.
    """
    own = F.size(words(F.col("text"))) if length is None else length
    rows = docs.select("doc_id", F.coalesce(own, F.lit(0)).cast("long").alias("length"))
    rows = rows.withColumn("class", length_class(F.col("length"), exact))
    # Each class counts with the longest length it has.
    counted = {r["longest"]: r["n"] for r in rows.groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).collect()}
    upper = bounds(list(counted.items()), buckets)
    bucket, padded, first, before, per = (F.lit(0).cast("long") for _ in range(5))
    done = batches = 0
    for i, bound in enumerate(upper):
        held = sum(n for c, n in counted.items() if c <= bound and (not i or c > upper[i - 1]))
        fit = max(budget // max(bound, 1), 1)
        inside = F.col("length") > (upper[i - 1] if i else -1)
        bucket, padded, first, before, per = (
            F.when(inside, F.lit(v).cast("long")).otherwise(x) for v, x in
            ((i, bucket), (bound, padded), (done, first), (batches, before), (fit, per)))
        done += held
        batches += -(-held // fit)
    placed = global_position(rows.withColumn("bucket", bucket.cast("int")), "bucket", "doc_id", "length")
    place = F.col("pos") - first
    return placed.select(
        "doc_id", "length", "bucket", padded.alias("padded"),
        (before + F.floor(place / per)).cast("long").alias("batch"), F.pmod(place, per).cast("int").alias("slot"))
