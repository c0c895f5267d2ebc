"""Exact, near and substring duplicates."""

from collections import defaultdict

import numpy as np
import pytest
import xxhash
from brute import LAST, lower, ordered, same, words

from clipledger.llm import simhash
from clipledger.llm.exact_dedup import exact_groups
from clipledger.llm.simhash import bucket_components, components, fingerprint, links, near_duplicates
from clipledger.llm.substring_dedup import remove_repeats, rounds


@pytest.mark.parametrize("partitions", [4, 40])
def test_exact_groups(spark, docs, rows, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)   # with 40, groups of two copies are cut already
    try:
        got = exact_groups(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    assert len(got) == len(rows)
    by_hash = defaultdict(list)
    for r in got:
        by_hash[r["text_sha256"]].append(r)
    import hashlib

    for text, ids in groups.items():
        own = by_hash[hashlib.sha256(text.encode()).hexdigest()]
        largest = max((i for i in ids if i is not None), default=None)
        assert ordered((r["doc_id"],) for r in own) == ordered((i,) for i in ids)
        assert {(r["keep_id"], r["group_size"]) for r in own} == {(largest, len(ids))}
        assert [r["doc_id"] for r in own if r["kept"]] == [largest]


def _print(text):
    ws = lower(text).encode().split()
    ws = [w.encode() for w in words(lower(text))]
    shingles = [b" ".join(ws[i:i + 3]) for i in range(max(len(ws) - 2, min(len(ws), 1)))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_near_duplicates(docs, rows):
    prints = [_print(r[1]) for r in rows]
    assert [fingerprint(r[1]) for r in rows] == prints
    roots = _components(prints, 3)
    least = defaultdict(lambda: None)
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = r[0] if least[root] is None else min(least[root], r[0])
    found = near_duplicates(docs, carry=("text", "fp"))
    same(found, [(r[0], f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots)],
         "doc_id", "fingerprint", "component_id")
    assert found.where("stays").count() == len(set(roots))
    assert found.where("stays and not (doc_id <=> component_id)").count() == 0


def _noisy(rng, centres, each, flips):
    out = set()
    for c in rng.integers(0, 1 << 64, centres, dtype=np.uint64):
        for _ in range(each):
            v = int(c)
            for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
                v ^= 1 << int(b)
            out.add(v)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_bit_sliced_components(radius):
    rng = np.random.default_rng(radius)
    values = _noisy(rng, 6, 60, 6) + [0, 1, 3, (1 << 64) - 1]
    fps = np.array(values, np.uint64)
    for groups in (1, 5):
        bucket = np.sort(rng.integers(0, groups, len(fps)))
        got = bucket_components(fps, bucket, radius)
        for g in range(groups):
            at = np.flatnonzero(bucket == g)
            assert [int(x) for x in got[at]] == [int(at[k]) for k in _components([values[i] for i in at], radius)]


@pytest.mark.parametrize("tile", [4096, 16])
def test_links_lose_no_pair(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    values = _noisy(np.random.default_rng(9), 12, 50, 4)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    root = {r["node"]: r["root"] for r in components(links(frame, 3)).collect()}
    expected = defaultdict(set)
    for v, c in zip(signed, _components(values, 3)):
        expected[c].add(v)
    got = defaultdict(set)
    for v in signed:
        got[root.get(v, v)].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(-5, 7), (200, 150)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: -5 for i in range(41)} | {100 + i: 100 for i in range(1, 60)} | {200: 100}


def _removed(rows, window):
    texts = [(LAST if r[0] is None else r[0], words(r[1])) for r in rows]
    first = {}
    for i, ws in texts:
        for p in range(len(ws) - window + 1):
            key = tuple(ws[p:p + window])
            first[key] = min(first.get(key, (LAST, LAST)), (i, p))
    for (i, ws), r in zip(texts, rows):
        gone = set()
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p:p + window])] != (i, p):
                gone.update(range(p, p + window))
        yield r[0], len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)


@pytest.mark.parametrize("window", [20, 18, 31])
def test_substrings(docs, rows, small_batches, window):
    same(remove_repeats(docs, window), _removed(rows, window), "doc_id", "n_words", "n_removed", "kept_text")


def test_substrings_in_one_batch_keep_white_space(docs, rows):
    plain = {(a, b, c, d if c else None) for a, b, c, d in _removed(rows, 20)}
    got = remove_repeats(docs, carry=("text", "lang"), rejoin=False).collect()
    assert {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"] if r["n_removed"] else None) for r in got} == plain
    assert all(r["kept_text"] == (r["carried"]["text"] or "") for r in got if not r["n_removed"])


def test_equal_sequences_get_equal_names_inside():
    rng = np.random.default_rng(4)
    for _ in range(200):
        middle = rng.integers(0, 4, 20).astype(np.uint64)
        inside = []
        for _ in range(2):
            left, right = (rng.integers(0, 4, rng.integers(0, 9)).astype(np.uint64) for _ in range(2))
            words_ = np.concatenate([left, middle, right])
            names, first = rounds(words_, np.zeros(len(words_), np.int64))
            after = np.append(first[1:], len(words_))
            at = (first >= len(left) + 5) & (after <= len(left) + 15)
            assert at.any() and (after - first <= 4).all()
            inside.append((names[at].tolist(), (first[at] - len(left)).tolist()))
        assert inside[0] == inside[1]


def test_empty_tables(none):
    assert exact_groups(none).count() == 0
    assert near_duplicates(none).count() == 0
    assert remove_repeats(none).count() == 0


def _twins():
    """Two words whose polynomials modulo 2^64 agree for every base."""
    ab = "".join("ab"[bin(i).count("1") % 2] for i in range(1_024))
    return ab, ab.translate(str.maketrans("ab", "ba"))


def test_words_that_share_a_polynomial(spark):
    x, y = _twins()
    docs = spark.createDataFrame(
        [(1, " ".join([f"w{i}" for i in range(10)] + [x] + [f"w{i}" for i in range(10, 19)])),
         (2, " ".join([f"w{i}" for i in range(10)] + [y] + [f"w{i}" for i in range(10, 19)]))], "doc_id bigint, text string")
    assert [r["n_removed"] for r in remove_repeats(docs).orderBy("doc_id").collect()] == [0, 0]


def test_names_of_words():
    from clipledger.llm.tokens import Spans

    x, y = _twins()
    spans = Spans([f"{x} b\t{y}".encode(), b"", f" B {x.upper()}".encode()])
    assert spans.words().to_pylist() == [w.encode() for w in (x, "b", y, "B", x.upper())]
    for lane in (0, 1):
        a, b, c, d, e = spans.hashes(lane).tolist()
        assert len({a, b, c, d, e}) == 5
        assert spans.hashes(lane, lower=True).tolist() == [a, b, c, b, a]
    assert not set(spans.hashes(0).tolist()) & set(spans.hashes(1).tolist())
