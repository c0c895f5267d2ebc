"""Periodic runs of words: seeds on diagonals, extended once.

In a run of period q each word equals the one q words on, over at least
max(m - q, q) words in a row (m: the least length of a run).  Lags fall into
classes; the overlap that a class guarantees holds a whole aligned block of h
words.  So a class indexes the h-grams, pairs each aligned one with the same
h-gram of the same document at a lag of the class, and a table with the
furthest block covered on every lag lets only the first pair of a match be
extended.  A class has at most 4 pairs a word (the first 4h), whatever repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.tokens import Spans, slices

PAIRS = 1 << 20   # pairs held at a time


class Repeats:
    """Places of the h-grams that a document has more than once, sorted by gram and place."""

    def __init__(self, places: np.ndarray, grams: np.ndarray):
        order = np.argsort(grams, kind="stable")   # `places` are rising
        grams, places = grams[order], places[order]
        new = np.diff(grams, prepend=grams[:1] - 1) != 0
        number = np.cumsum(new) - 1
        again = np.bincount(number, minlength=1)[number] > 1
        self.places, self.names = places[again], number[again]

    def longer(self, ends: np.ndarray, step: int) -> Repeats:
        """Grams of twice the length: two neighbours, `step` words apart, both repeated."""
        order = np.argsort(self.places, kind="stable")
        places, names = self.places[order], self.names[order]
        at = np.minimum(np.searchsorted(places, places + step), len(places) - 1)
        both = (places[at] == places + step) & (places + 2 * step <= ends[places])
        span = np.int64(names.max() + 1) if len(names) else 1
        return Repeats(places[both], names[both] * span + names[at[both]])

    def pairs(self, h: int, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, lag) of aligned grams and their like at lags first..last, by rising place in portions."""
        stride = np.int64(self.places.max() + last + 1) if len(self.places) else 1
        keys = self.names * stride + self.places
        seeds = np.flatnonzero(self.places % h == 0)
        seeds = seeds[np.argsort(self.places[seeds], kind="stable")]
        low = np.searchsorted(keys, keys[seeds] + first)
        many = np.searchsorted(keys, keys[seeds] + last, side="right") - low
        ends = np.cumsum(many)
        cut = 0
        while cut < len(seeds):
            done = ends[cut - 1] if cut else 0
            to = max(int(np.searchsorted(ends, done + PAIRS, side="right")), cut + 1)
            n = many[cut:to]
            place = np.repeat(self.places[seeds[cut:to]], n)
            inside = np.arange(len(place)) - np.repeat(ends[cut:to] - n - done, n)
            yield place, self.places[np.repeat(low[cut:to], n) + inside] - place
            cut = to


def _matches(repeats: Repeats, h: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lag, begin, end) of stretches of aligned blocks that match on one lag."""
    begun = np.full(last + 1, -1, np.int64)     # on each lag the match that may go on
    covered = np.full(last + 1, -1, np.int64)   # and how far it is covered
    out: list[tuple] = []
    for place, lag in repeats.pairs(h, first, last):
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        fresh = np.diff(lag, prepend=-1) != 0
        before = np.where(fresh, covered[lag], np.concatenate(([0], place[:-1] + h)))
        head = place > before
        ended = fresh & head & (covered[lag] >= 0)
        out.append((lag[ended], begun[lag[ended]], covered[lag[ended]]))
        # A match is begun by its head, or in an earlier portion.
        opening = np.flatnonzero(fresh | head)
        of = np.searchsorted(opening, np.arange(len(place)), side="right") - 1
        start = np.where(head[opening], place[opening], begun[lag[opening]])[of]
        final = np.diff(lag, append=-1) != 0
        closing = np.concatenate((head[1:], [False])) & ~final   # the next pair on this lag is a head
        out.append((lag[closing], start[closing], place[closing] + h))
        begun[lag[final]], covered[lag[final]] = start[final], place[final] + h
    left = np.flatnonzero(covered >= 0)
    out.append((left, begun[left], covered[left]))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def _extent(codes: np.ndarray, at: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
    """How many words from `at` on, in direction `step`, equal those a lag behind them."""
    n, size = len(codes), np.zeros(len(at), np.int64)
    active, width = np.arange(len(at)), 4
    while len(active):
        going = []
        for part in np.array_split(active, max(len(active) * width // PAIRS, 1)):
            here = (at[part] + step * size[part])[:, None] + step * np.arange(width)
            there = here + lag[part][:, None]
            inside = (here >= 0) & (there < n)
            same = inside & (codes[np.where(inside, here, 0)] == codes[np.where(inside, there, 0)])
            met = np.where(same.all(1), width, (~same).argmax(1))
            size[part] += met
            going.append(part[met == width])
        active, width = np.concatenate(going), min(4 * width, 4096)
    return size


def find_runs(codes: np.ndarray, counts: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period; starts count over all documents.

    codes: the words as numbers, one document after another; counts: words of each.
    """
    counts = counts.astype(np.int64)
    ends_of = np.cumsum(counts)
    document = np.repeat(np.arange(len(counts)), counts)
    ends = ends_of[document]
    size = np.int64(codes.max() + 1) if len(codes) else 1
    codes = document * size + codes            # words of two documents are never equal
    h = ((least + 1) // 2 + 1) // 2            # 2h - 1 words in a row hold an aligned block of h
    places, grams = np.arange(len(codes)), codes
    repeats = Repeats(places, grams)
    for k in range(1, h):
        order = np.argsort(repeats.places, kind="stable")
        places, grams = repeats.places[order], repeats.names[order]
        fits = places + k < ends[places]
        places = places[fits]
        repeats = Repeats(places, grams[fits] * (size * len(counts)) + codes[places + k])
    found, first, last = [], 1, 4 * h - 1
    longest = int(counts.max()) if len(counts) else 0
    while len(repeats.places) and 2 * first <= longest:
        lag, begin, end = _matches(repeats, h, first, last)
        begin = begin - _extent(codes, begin - 1, lag, -1)
        end = end + _extent(codes, end, lag, 1)
        runs = end - begin >= np.maximum(least - lag, lag)
        found.append(np.stack([begin, end - begin + lag, lag], 1)[runs])
        repeats = repeats.longer(ends, h)
        h, first, last = 2 * h, last + 1, 2 * last + 1
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # A stretch with two periods, at least twice as long as both, has their smallest alone.
    rows = rows[(np.diff(rows[:, :2], axis=0, prepend=-1) != 0).any(1)]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _covered(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that some run has behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def _of_texts(texts: list[bytes], least: int) -> list[pa.Array]:
    """Word counts, runs and collapsed texts."""
    spans = Spans(texts)
    words = spans.words()
    coded = words.dictionary_encode()
    runs = find_runs(coded.indices.to_numpy().astype(np.int64), spans.counts, least)
    ends = np.cumsum(spans.counts)
    firsts = ends - spans.counts
    of = np.searchsorted(ends, runs[:, 0], side="right")
    held = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(texts)))))
    triples = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - firsts[of]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
    keep = ~_covered(runs, len(words))
    kept = np.concatenate(([0], np.cumsum(np.bincount(spans.text[keep], minlength=len(texts)))))
    lists = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), words.filter(pa.array(keep)))
    joined = pc.binary_join(lists, pa.scalar(b" ", words.type))
    return [pa.array(spans.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(held, pa.int32()), triples),
            joined.cast(pa.large_string()).cast(pa.string())]


def periodic_runs(docs: DataFrame, least: int = 12, text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period, by start and period) and collapsed.

    A run is a stretch of words with smallest period q, at least `least` and
    2q words long, that no neighbouring word extends with that period.
    collapsed joins by one space the words that no run has behind its first q.
    Null and blank texts have no words, no runs and an empty text; null and
    repeated doc_ids and repeated rows are answered alike, other columns are
    not read, and an empty table gives no rows.  A task holds half a megabyte
    of text at a time; a longer text is held alone, at some 40 bytes a word and
    24 more for each of its repeated words.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for rows in slices(batch):
                texts = [t or b"" for t in rows.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *_of_texts(texts, least)], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
             "collapsed string")
