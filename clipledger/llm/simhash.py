"""SimHash near-duplicates: fingerprints, bit-sliced comparison, components.

Two fingerprints within `radius` bits agree on at least two of radius + 2
bands.  So every pair of bands gives a bucket key, and each fingerprint is
compared in as many buckets as there are pairs; no link is lost.  A task lays
the bit planes of its fingerprints out vertically, 64 fingerprints to a word,
and compares all of them with those `d` places on at once: carry-save counters
take in one plane after another, and a word whose 64 distances all exceed the
radius is abandoned.  A bucket returns its components, never its pairs.
Buckets above TILE fingerprints are cut into blocks, and every two blocks are
compared by a task of their own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.common import carried, lookup_counted, partitions
from clipledger.llm.tokens import slices
from clipledger.session import stored

BITS = 64
SEED = 42            # fixed value: the seed of the shingle hash
TILE = 4096          # fingerprints of a bucket that are compared in one piece
UNIT_ROWS = 40_000   # bucket rows handed to one call
CHECK_EVERY = 8      # planes between two looks for words to abandon


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 for no words."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII case and white space only
    if not ws:
        return 0
    flat = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(ws))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(flat[a:b], SEED) for a, b in zip(starts[: len(ws) - k + 1].tolist(), ends[k - 1:].tolist())),
        np.uint64, len(ws) - k + 1)
    counts = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[part:part + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, fp (the 64 bits as a signed long) and the struct `carried`."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                fps = np.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("carried"), pa.array(fps.view(np.int64))],
                    ["doc_id", "carried", "fp"])

    rows = docs.select("doc_id", "text", carried(carry))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, carried {kinds['carried']}, fp bigint")


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 to a word; one more word of zeros."""
    words = -(-len(fps) // 64) + 1
    bits = np.zeros((BITS, words * 64), np.uint8)
    bits[:, : len(fps)] = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _within(planes: np.ndarray, shift: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Of the `wanted` positions i, those where fingerprints i and i + shift differ in at most `radius` bits."""
    mask = np.packbits(wanted, bitorder="little")
    mask = np.concatenate([mask, np.zeros(-len(mask) % 8, np.uint8)]).view(np.uint64)
    live = np.flatnonzero(mask)
    over = ~mask[live]
    limit = radius.bit_length()
    # Counters start so that passing the radius carries out of the highest one.
    start = (1 << limit) - 1 - radius
    counters = [np.full(len(live), -((start >> k) & 1), np.int64).view(np.uint64) for k in range(limit)]
    skip, bits = divmod(shift, 64)
    low, high = np.uint64(bits), np.uint64(64 - bits)
    edge = planes.shape[1] - 1
    for b in range(BITS):
        row = planes[b]
        other = row[np.minimum(live + skip, edge)]
        if bits:
            other = (other >> low) | (row[np.minimum(live + skip + 1, edge)] << high)
        carry = row[live] ^ other
        for k in range(limit):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % CHECK_EVERY == CHECK_EVERY - 1:
            alive = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not alive.all():
                live, over, counters = live[alive], over[alive], [c[alive] for c in counters]
                if not len(live):
                    break
    hit = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(hit)
    return live[at] * 64 + bit


def bucket_components(fps: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """For fingerprints sorted by bucket: the first position of each one's component in its bucket."""
    root = np.arange(len(fps))
    planes = planes_of(fps)
    for shift in range(1, len(fps)):
        wanted = bucket[:-shift] == bucket[shift:]
        if not wanted.any():
            break
        left = _within(planes, shift, wanted, radius)
        if not len(left):
            continue
        right = left + shift
        while True:   # hook the larger root under the smaller one, then shorten the paths
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                break
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                shorter = root[root]
                if (shorter == root).all():
                    break
                root = shorter
    return root


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints whose components are those of all pairs within `radius` bits.

    fps: one row for each fingerprint, column fp.
    """
    bands = radius + 2
    cuts = [BITS * i // bands for i in range(bands + 1)]
    masks = [sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in pair) for pair in combinations(range(bands), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fps.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])).alias("bucket"))
    sizes = stored(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    many = sizes.where(F.col("n") > TILE).select("bucket", F.ceil(F.col("n") / TILE).cast("int").alias("blocks"))
    keyed = keyed.join(many, "bucket", "left")
    block = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.xxhash64(
        "bucket", F.least(x, block), F.greatest(x, block)))
    tiled = keyed.select("fp", F.explode(
        F.when(F.col("blocks").isNull(), F.array("bucket")).otherwise(tiles)).alias("bucket"))
    rows = sizes.agg(F.sum(F.col("n") * F.ceil(F.col("n") / TILE))).first()[0] or 0
    units = max(rows // UNIT_ROWS, partitions(fps))

    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        bucket = table.column("bucket").to_numpy()
        order = np.lexsort((fp, bucket))
        fp, bucket = fp[order], bucket[order]
        twin = np.zeros(len(fp), bool)
        twin[1:] = bucket[1:] == bucket[:-1]
        twin[:-1] |= twin[1:].copy()
        fp, bucket = np.ascontiguousarray(fp[twin]), bucket[twin]
        root = bucket_components(fp, bucket, radius)
        moved = np.flatnonzero(root != np.arange(len(fp)))
        return pa.table({"a": fp[moved].view(np.int64), "b": fp[root[moved]].view(np.int64)})

    found = tiled.withColumn("unit", F.pmod("bucket", F.lit(units))).groupBy("unit").applyInArrow(run, "a bigint, b bigint")
    return found.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Per node of `edges` (a, b): node and root, the smallest node reachable.

    Alternating large and small stars; every round is written to the shared
    folder.  A node with many neighbours is counted by partial aggregation and
    looked up with its rows dealt out.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        both = stored(both, "star")
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"),
                                             F.count(F.lit(1)).alias("n")), "least")
        seen = lookup_counted(both, least, "a", "n", ["m"], F.xxhash64("a", "b"))
        if large:
            out = seen.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = seen.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = mark(now)
    while state[0]:
        now = stored(stars(stored(stars(now, True), "edges"), False), "edges")
        after = mark(now)
        if after == state:
            break
        state = after
    # Every edge now leads straight to the smallest node.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), stays and `carried`.

    Of each component one row stays, one with the smallest id.  Texts without
    words have fingerprint zero and link like any other.  Null ids count as
    the largest, so a component_id is null only where all its ids are;
    repeated rows share a fingerprint and so a component.  Columns outside
    `carry` are not read; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle, carry).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    distinct = stored(prints.groupBy("fp").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(stored(links(distinct.select("fp"), radius), "links"))
    rooted = stored(distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")), "rooted")
    named = stored(rooted.groupBy("root").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("fps")), "named")
    of = stored(lookup_counted(rooted, named, "root", "fps", ["first"], F.col("fp")).select("fp", "n", "first"), "of")
    return lookup_counted(prints, of, "fp", "n", ["first"], F.xxhash64("row")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"), (F.col("row") == F.col("first.row")).alias("stays"), "carried")
