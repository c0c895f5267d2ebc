"""Collocations against plain counts, and the counting quotient filter."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import lower
from hypothesis import given, settings
from hypothesis import strategies as st

from clipledger.llm import collocations as module
from clipledger.llm.collocations import collocations, cut_score, tokens
from clipledger.llm.quotient_filter import WIDEST, CountingFilter, Shape


def brute(rows, least, inside, top):
    """rows: (lang, text)."""
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            word = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(word[i:i + n]) for i in range(len(word) - n + 1))
    out = []
    for lang, count in f.items():
        n = sum(c for g, c in count.items() if len(g) == 1)
        found = {g: c for g, c in count.items() if len(g) > 1 and c >= least}
        scored = []
        for g, a in found.items():
            if any(len(x) > len(g) and 100 * c >= inside * a and g in (x[:-1], x[1:]) for x, c in found.items()):
                continue
            score, k = min((10**6 * a * a // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), count[g[:k]], count[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return out


def check(df, rows, least=10, inside=50, top=2_000):
    got = collocations(df, least, inside, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    want = brute(rows, least, inside, top)
    assert sorted(tuple(r) for r in got) == sorted(want)
    return want


def made(seed, rows=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["New", "york", "NEW", "É", "é", "日本", "a'b", "x-y", " "]
    out = []
    for i in range(rows):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(["new york", "New York City", "de facto", rng.choice(vocabulary)]))
            parts.append(rng.choice([" "] * 6 + ["\t ", ", ", ". ", "\n", "\r", "!?", " ; "]))
        out.append((rng.choice(["en", "en", "fr", None, "und", ""]), "".join(parts)))
    return out + [("en", None), (None, ""), ("zz", " \t"), ("long", "p q r " * 6_000 + "s. t")] + out[:3]


@pytest.mark.parametrize("least, inside, top", [(10, 50, 2_000), (2, 100, 5), (1, 1, 2_000), (30, 0, 2_000)])
def test_random_texts(spark, least, inside, top):
    rows = made(least)
    df = spark.createDataFrame([(l, t, 1, "p") for l, t in rows], "lang string, text string, n int, phrase string")
    assert len(check(df.repartition(5), rows, least, inside, top)) > 3


def test_across_batches_and_portions(spark, monkeypatch):
    rows = made(77)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    with monkeypatch.context() as m:
        m.setattr(module, "PART_WORDS", 40)
        m.setattr(module, "BATCH_BYTES", 4_000)
        check(df, rows)


@pytest.mark.parametrize("size", [1, 7, 50, 1_000])
def test_portions_of_a_text(size):
    """Words and the pieces they begin do not depend on where a long text is cut."""
    text = " .a,B  c\td.\n. eee fff;g" * 9 + "x" * 200 + " é! "
    whole, begins = tokens(text.encode())
    parts = [tokens(*s) for s in module._segments([text.encode()], size)]
    assert [w for p, _ in parts for w in p.to_pylist()] == whole.to_pylist()
    assert [b for _, p in parts for b in p.tolist()] == begins.tolist()


def test_odd_rows(docs, rows):
    check(docs, [(r[2], r[1]) for r in rows])


def test_no_rows(none, spark):
    assert collocations(none).count() == 0
    assert collocations(spark.createDataFrame([("en", "a b")], "lang string, text string")).count() == 0


def test_exact_score(spark):
    cases = [(10**14 + 7, 10**14 + 7, 10**14 + 9), (999, 1000, 10**14), (7, 7, 7), (3_037_000_500, 3_037_000_501, 3_037_000_502)]
    df = spark.createDataFrame(cases, "a bigint, l bigint, r bigint")
    got = [r[0] for r in df.select(cut_score(df.a, df.l, df.r)).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in cases]


@settings(max_examples=150, deadline=None)
@given(st.sampled_from([2, 3]), st.integers(1, WIDEST), st.integers(0, 5), st.data())
def test_filter_is_lossless(order, width, top, data):
    shape = Shape(order, width)
    top = min(top, shape.high)
    small = st.integers(0, min(3, (1 << width) - 1))
    gram = st.tuples(*[st.one_of(small, st.integers(0, (1 << width) - 1))] * order)
    shards = data.draw(st.lists(st.lists(gram, max_size=60), min_size=1, max_size=4))
    want = Counter(g for s in shards for g in s)
    pieces = defaultdict(list)
    for s in shards:
        ids = [np.array([g[k] for g in s], np.int64) for k in range(order)]
        for part, f in CountingFilter.of(shape, *ids).split(top):
            pieces[part].append(CountingFilter.from_bytes(f.to_bytes(top), shape, part))
    got = {}
    for part, held in pieces.items():
        f = CountingFilter.merged(held)
        ids, counts = f.items()
        got.update(zip(zip(*[i.tolist() for i in ids]), counts.tolist()))
        assert len(f.counts) == len(set(zip(f.high.tolist(), f.low.tolist())))
    assert got == want


def test_large_counts_and_compact_form():
    shape = Shape(3, 17)
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 1 << 17, 50_000) for _ in range(3)]
    f = CountingFilter.of(shape, *ids)
    f.counts = f.counts * np.where(np.arange(len(f.counts)) % 100 == 0, 1 << 40, 1)
    data = f.to_bytes()
    back = CountingFilter.from_bytes(data, shape)
    assert (back.high == f.high).all() and (back.low == f.low).all() and (back.counts == f.counts).all()
    assert len(data) < 9 * len(f.counts)   # of 51 bits a key and 64 a count


def test_refused_widths():
    with pytest.raises(ValueError, match="bits"):
        Shape(3, WIDEST + 1)
