"""Shards of near-equal bytes that keep equal texts together.

Groups of equal texts are laid out in the order of a hash of the text, groups
above a fair share first with a shard of their own.  The smallest capacity for
which a greedy walk needs no more shards than there are is found by binary
search.  The driver walks over sums of hash ranges (some thousands at first);
ranges in which a cut falls are split further until each cut, at the capacity
found and at the one below, stands next to a single group, so the capacity is
that of the whole table.  Cuts then move as far towards equal sizes as the
capacity allows.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.operators.ordering import global_position
from clipledger.session import stored

ROW_BYTES = 16     # added to the bytes of each text
FIRST_BITS = 12    # hash bits of the first ranges
MORE_BITS = 8      # bits by which a range is split


@dataclass(frozen=True, order=True)
class Block:
    start: int     # smallest hash of the range
    bits: int
    size: int
    groups: int


def _sums(groups: DataFrame, bits: int, within: Column) -> list[Block]:
    drop = 64 - bits
    at = F.shiftright("h", drop) if drop else F.col("h")
    found = groups.where(within).groupBy(at.alias("p")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    return [Block(r["p"] << drop, bits, r["size"], r["n"]) for r in found]


def _split(groups: DataFrame, blocks: list[Block], which: set[int], free: Column) -> list[Block]:
    out = [b for i, b in enumerate(blocks) if i not in which]
    for bits in sorted({blocks[i].bits for i in which}):
        own = [blocks[i].start >> (64 - bits) for i in which if blocks[i].bits == bits]
        out += _sums(groups, min(bits + MORE_BITS, 64), free & F.shiftright("h", 64 - bits).isin(own))
    return sorted(out)


def _walk(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Greedy cuts: how many blocks the first 1, 2 ... shards hold."""
    cuts, done = [], 0
    for _ in range(shards):
        done = bisect_right(ends, (ends[done - 1] if done else 0) + capacity)
        cuts.append(done)
    return cuts


def _capacity(sizes: list[int], ends: list[int], shards: int) -> int:
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if _walk(ends, middle, shards)[-1] == len(ends):
            high = middle
        else:
            low = middle + 1
    return low


def _levelled(sizes: list[int], ends: list[int], capacity: int, shards: int) -> list[int]:
    """Cuts within `capacity`, each as near to its share of the total as later shards permit."""
    backward = _walk(list(accumulate(reversed(sizes))), capacity, shards)
    cuts, done = [], 0
    for j in range(1, shards + 1):
        start = ends[done - 1] if done else 0
        last = bisect_right(ends, start + capacity)
        first = max(done, len(ends) - (backward[shards - j - 1] if j < shards else 0))
        aim = ends[-1] * j // shards
        near = bisect_right(ends, aim)
        if near < len(ends) and ends[near] - aim < aim - (ends[near - 1] if near else 0):
            near += 1
        done = min(max(near, first), last)
        cuts.append(done)
    return cuts


def plan_shards(groups: DataFrame, shards: int) -> tuple[list[int], list[int], int]:
    """Hashes with a shard of their own, first hashes of all later shards but one, and the capacity.

    groups: h (long, unique), size.
    """
    total = groups.agg(F.sum("size")).first()[0] or 0
    # Fewer than `shards` groups can exceed a fair share.
    large = sorted(((r["size"], r["h"]) for r in groups.where(F.col("size") * shards > total).collect()), reverse=True)
    alone, rest = [], total
    for size, h in large:
        if len(alone) < shards - 1 and size * (shards - len(alone)) > rest:
            alone.append(h)
            rest -= size
    free = ~F.col("h").isin(alone) if alone else F.lit(True)
    left = shards - len(alone)
    blocks = sorted(_sums(groups, FIRST_BITS, free))
    if not blocks:
        return alone, [], max([s for s, _ in large], default=0)
    while True:
        sizes = [b.size for b in blocks]
        ends = list(accumulate(sizes))
        capacity = _capacity(sizes, ends, left)
        beside = {*_walk(ends, capacity, left), *_walk(ends, capacity - 1, left)}
        beside |= {i for i, s in enumerate(sizes) if s == capacity}
        coarse = {i for i in beside if i < len(blocks) and blocks[i].groups > 1}
        if not coarse:
            break
        blocks = _split(groups, blocks, coarse, free)
    cuts = _levelled(sizes, ends, capacity, left)
    starts = [blocks[c].start if c < len(blocks) else None for c in cuts[:-1]]
    return alone, [s for s in starts if s is not None], max([capacity, *[s for s, h in large if h in alone]])


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law).

    Rows with equal texts share a shard; null texts form one group, with the
    size and checksum of an empty text.  Rows of a shard are numbered from 0 by
    (hash, doc_id); repeated rows get slots of their own.  Other columns are
    not read; an empty table gives an empty result.
    """
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        F.xxhash64("text").alias("h"))
    groups = stored(rows.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    alone, starts, _ = plan_shards(groups, shards)
    shard = F.lit(len(alone))
    for start in starts:
        shard = shard + (F.col("h") >= start).cast("int")
    for i, h in reversed(list(enumerate(alone))):
        shard = F.when(F.col("h") == h, i).otherwise(shard)
    placed = global_position(rows.withColumn("shard", shard.cast("int")), "shard", "h", "doc_id")
    firsts = placed.groupBy("shard").agg(F.min("pos").alias("first"))   # one row for each shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("pos") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
