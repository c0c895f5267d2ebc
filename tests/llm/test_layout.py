"""Sharding and packing."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
from brute import words

from clipledger.llm import sharding
from clipledger.llm.packing import bounds, pack_lengths
from clipledger.llm.sharding import plan_shards, shard_documents


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(docs, rows, shards):
    got = shard_documents(docs, shards).collect()
    size = lambda t: 16 + len((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    slots = defaultdict(list)
    of = defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        of[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    null_or_empty = {(16, 0)}
    assert all(len(s) == 1 for key, s in of.items() if key not in null_or_empty)


def _least(sizes, shards):
    """The smallest capacity, by trying all of them."""
    for capacity in range(max(sizes), sum(sizes) + 1):
        used, held = 1, 0
        for s in sizes:
            used, held = (used + 1, s) if held + s > capacity else (used, held + s)
        if used <= shards:
            return capacity


@pytest.mark.parametrize("seed", range(3))
def test_capacity_is_the_smallest(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "MORE_BITS", 3)
    rng = random.Random(seed)
    groups = sorted({rng.getrandbits(64) - (1 << 63): rng.randint(1, 50) for _ in range(120)}.items())
    frame = spark.createDataFrame(groups, "h bigint, size bigint")
    for shards in (3, 11):
        alone, starts, capacity = plan_shards(frame, shards)
        assert not alone and capacity == _least([s for _, s in groups], shards)
        sums = Counter()
        for h, s in groups:
            sums[sum(h >= x for x in starts)] += s
        assert max(sums.values()) <= capacity and len(starts) <= shards - 1


def test_a_large_group_has_a_shard_of_its_own(spark):
    groups = [(-5, 10_000)] + [(i << 50, 10) for i in range(200)]
    alone, starts, capacity = plan_shards(spark.createDataFrame(groups, "h bigint, size bigint"), 5)
    assert alone == [-5] and len(starts) == 3 and capacity == 10_000
    sums = Counter(sum(h >= x for x in starts) for h, _ in groups[1:])
    assert set(sums.values()) == {50}


def test_bounds_waste_the_least():
    rng = random.Random(2)
    for _ in range(150):
        histogram = list({rng.randint(0, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}.items())
        lengths, buckets = sorted(n for n, _ in histogram), rng.randint(1, 5)
        waste = lambda b: sum((min(x for x in b if x >= n) - n) * c for n, c in histogram)
        best = min(waste({*c, lengths[-1]}) for k in range(min(buckets, len(lengths)))
                   for c in itertools.combinations(lengths[:-1], k))
        found = bounds(histogram, buckets)
        assert waste(found) == best and len(found) <= buckets


def test_packing(docs, rows):
    got = pack_lengths(docs, buckets=4, budget=300).collect()
    assert Counter((r["doc_id"], r["length"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    held = defaultdict(list)
    for r in got:
        assert r["length"] <= r["padded"]
        held[r["batch"]].append(r)
    assert sorted(held) == list(range(len(held)))
    last = {}
    for batch, own in held.items():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        (bucket, padded), = {(r["bucket"], r["padded"]) for r in own}
        assert len(own) == 1 or len(own) * padded <= 300
        last[bucket] = max(last.get(bucket, 0), batch)
    fit = lambda own: max(300 // max(own[0]["padded"], 1), 1)
    assert all(len(own) == fit(own) for batch, own in held.items() if batch != last[own[0]["bucket"]])


def test_lengths_are_exact(spark):
    """As many buckets as lengths: nothing is padded, whatever the lengths; a bounded histogram pads to the longest held."""
    lengths = [4_097, 4_099, 4_101, 70_001]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths * 3)], "doc_id bigint, n bigint")
    for exact in (None, 4_096):
        got = pack_lengths(df, df.n, buckets=4, exact=exact).collect()
        assert all(r["padded"] == r["length"] for r in got)
    coarse = pack_lengths(df, df.n, buckets=4, exact=1_024).collect()
    assert {(r["length"], r["padded"]) for r in coarse} == {(4_097, 4_101), (4_099, 4_101), (4_101, 4_101), (70_001, 70_001)}


def test_empty_tables(none):
    assert shard_documents(none).count() == 0
    assert pack_lengths(none).count() == 0
