"""Periodic runs against all periods of all stretches."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import words
from hypothesis import given, settings
from hypothesis import strategies as st

from clipledger.llm import runs
from clipledger.llm.runs import find_runs, periodic_runs


def brute(word, least=12):
    """Maximal stretches of each period, smallest periods first."""
    n, found = len(word), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if word[i] != word[i + q]:
                i += 1
                continue
            begin = i
            while i + q < n and word[i] == word[i + q]:
                i += 1
            length = i - begin + q
            if length >= max(least, 2 * q):
                found.setdefault((begin, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(word, found):
    gone = set()
    for start, length, q in found:
        gone.update(range(start + q, start + length))
    return " ".join(w for i, w in enumerate(word) if i not in gone)


def numbers(texts, least=12):
    codes = np.array([w for t in texts for w in t], np.int64)
    return [tuple(r) for r in find_runs(codes, np.array([len(t) for t in texts]), least).tolist()]


def shifted(texts, least=12):
    out, at = [], 0
    for t in texts:
        out += [(s + at, n, q) for s, n, q in brute(t, least)]
        at += len(t)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), max_size=4), st.sampled_from([2, 3, 5, 7, 12, 13, 30]))
def test_few_letters(texts, least):
    assert numbers(texts, least) == shifted(texts, least)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_built_of_copies(data):
    text = data.draw(st.lists(st.integers(0, 3), min_size=1, max_size=6))
    for _ in range(data.draw(st.integers(1, 5))):
        a = data.draw(st.integers(0, len(text) - 1))
        part = text[a:data.draw(st.integers(a + 1, len(text)))]
        text = (text + part * data.draw(st.integers(1, 5)))[:400]
    assert numbers([text, text]) == shifted([text, text])


def known():
    fib, other = [0], [0, 1]
    while len(other) < 600:
        fib, other = other, other + fib
    morse = [bin(i).count("1") % 2 for i in range(512)]
    deep = [0]
    for k in range(1, 9):
        deep = deep * 2 + [k]
    yield from (other, morse, deep, [7] * 500, [1, 2] * 200 + [3] + [2, 1] * 100, list(range(200)) * 3,
                list(range(97)) + list(range(96)), [], [1])


@pytest.mark.parametrize("pairs", [1, 50, 1 << 20])
def test_known_words(pairs, monkeypatch):
    monkeypatch.setattr(runs, "PAIRS", pairs)   # matches that go on from one portion to the next
    for text in known():
        assert numbers([[9], text, [9]]) == shifted([[9], text, [9]])


def test_pairs_are_linear():
    n = 1 << 14
    codes, places = np.zeros(n, np.int64), np.arange(n)
    for h, first in ((3, 1), (6, 12), (768, 1536)):
        made = sum(len(p) for p, _ in runs.Repeats(places, codes).pairs(h, first, 4 * h - 1))
        assert made <= 4 * n


def test_long_period():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 50_000, 40_000)
    text = np.concatenate((part, part, part[:123], [50_001], np.full(100_000, 3)))
    assert [tuple(r) for r in find_runs(text, np.array([len(text)])).tolist()] == [
        (0, 80_123, 40_000), (80_124, 100_000, 1)]


def test_table(docs, rows):
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect()]
    want = []
    for r in rows:
        word = words(r[1])
        found = brute(word) if len(word) < 2_000 else [
            tuple(x) for x in find_runs(np.unique(word, return_inverse=True)[1], np.array([len(word)])).tolist()]
        want.append((r[0], len(word), found, collapsed(word, found)))
    assert sorted(map(str, got)) == sorted(map(str, want))


def rewritten(doc_id, word):
    if doc_id is None or not word:
        return word
    h, n = zlib.crc32(str(doc_id).encode()), len(word)
    if h % 10:
        return word
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else word[a + (i - a) % p] for i, w in enumerate(word)]


def test_query(spark, docs, rows, tmp_path):
    from clipledger.llm.queries import op13_periodic_runs

    few = [r for r in rows if len(words(r[1])) < 2_000]
    few += [(10_000 + i, " ".join(f"w{(i * 7 + j * j) % 61}" for j in range(i)), *r[2:]) for i, r in enumerate(rows * 3)]
    random.Random(1).shuffle(few)
    spark.createDataFrame(few, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for r in few:
        word = rewritten(r[0], words(r[1]))
        found = brute(word)
        start, length, q = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        want.append((r[0], len(found), start, length, q, found and 1000 * length // q or None,
                     hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest(),
                     hashlib.sha256(collapsed(word, found).encode()).hexdigest()))
    got = op13_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
    assert sum(w[1] > 0 for w in want) > 20


def test_no_rows(none):
    assert periodic_runs(none).count() == 0
    with pytest.raises(ValueError, match="two words"):
        periodic_runs(none, least=1)
