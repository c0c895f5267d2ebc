"""Supervised subword embeddings for text quality.

Features of a text are its words, the windows of 3 and 4 characters inside
words with one boundary on either side, the distance of up to 4 words at which
a word is repeated, and one end, all hashed to buckets.  A text is the average
of its features' vectors, and a softmax over two classes follows.  Vectors and output weights are learned by stochastic gradient descent
on a bounded sample of labelled rows.  As the output is linear in the average,
each bucket's part in the difference of the two logits is one number, so a
text is scored by averaging numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.common import carried, held_out
from clipledger.llm.tokens import SPACE, Spans, mixed, segments, slices

TRAIN_ROWS = 4_000      # labelled rows that are fitted on, at most
BUCKETS = 1 << 18
WIDTH = 16
STEPS = 24_000          # gradient steps, however few rows there are
RATE = 0.5
THRESHOLD = 0.3
FOLDS = 5               # one in so many rows is held out
_END = 0                # bucket of the feature that every text has
_ECHO = 4               # buckets from 1 on: a word that was there 1, 2, ... words before
_GRAM = {3: np.uint64(0xA24BAED4963EE407), 4: np.uint64(0x9FB21C651E98DF25)}
_STEP = np.uint64(0xD1342543DE82EF95)


def _bucket(x: np.ndarray) -> np.ndarray:
    return np.maximum((mixed(x) >> np.uint64(64 - 18)).astype(np.int64), _ECHO + 1)


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the features of some texts, and the text each one is in, a portion of text at a time."""
    yield np.full(len(texts), _END, np.int64), np.arange(len(texts))
    last, last_of = np.zeros(0, np.uint64), np.zeros(0, np.int64)   # a long text goes on in the next portion
    for parts, owner in segments(texts):
        spans = Spans(parts)
        words, own = spans.hashes(), owner[spans.text]
        yield _bucket(words), own
        known = len(last)
        words, own = np.concatenate((last, words)), np.concatenate((last_of, own))
        for gap in range(1, _ECHO + 1):
            again = np.flatnonzero((words[gap:] == words[:-gap]) & (own[gap:] == own[:-gap])) + gap
            again = again[again >= known]
            yield np.full(len(again), gap, np.int64), own[again]
        last, last_of = words[-_ECHO:], own[-_ECHO:]
        # The text as characters, every white space one boundary, and one in front.
        chars = np.frombuffer(spans.raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.flatnonzero((spans.data & 0xC0) != 0x80)
        of = owner[np.searchsorted(spans.ends, begins, side="right")]
        space = np.concatenate(([True], (chars < 256) & SPACE[chars & 255]))
        chars = np.where(space, np.uint64(0x20), np.concatenate(([0], chars)).astype(np.uint64))
        for n, salt in _GRAM.items():
            size = len(chars) - n + 1
            if size <= 0:
                continue
            code, inside = np.zeros(size, np.uint64), np.ones(size, bool)
            for k in range(n):
                code = code * _STEP + chars[k:size + k]
                if 0 < k < n - 1:
                    inside &= ~space[k:size + k]
            at = np.flatnonzero(inside)
            yield _bucket(code[at] * salt), of[at]   # its second character, the one in front not counted


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's features, and how many of them fall into each."""
    counts = np.zeros(BUCKETS, np.int64)
    for ids, _ in features([text]):
        counts += np.bincount(ids, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """What `counted` gives, in about a fifth of the bytes: gaps between buckets, which are in order, and counts."""
    return pa.compress(np.diff(ids, prepend=0).astype("<u4").tobytes() + counts.astype("<i8").tobytes(), "zstd", asbytes=True)


def unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The `n` buckets and counts of a packed text."""
    raw = pa.decompress(blob, 12 * n, "zstd")
    return np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64), np.frombuffer(raw, "<i8", n, 4 * n)


class Packed(Sequence):
    """Rows for `fit` from a table (quality, n, found), one unpacked at a time."""

    def __init__(self, table: pa.Table):
        self.labels, self.sizes = (table.column(c).to_pylist() for c in ("quality", "n"))
        self.found = table.column("found")

    def __len__(self) -> int:
        return len(self.labels)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, int]:
        return *unpacked(self.found[i].as_buffer(), self.sizes[i]), self.labels[i]


def fit(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], steps: int = STEPS, rate: float = RATE, seed: int = 1) -> np.ndarray:
    """Per bucket its part in the logit of label 1 over label 0.  rows: buckets, counts and label of each text."""
    rng = np.random.default_rng(seed)
    vectors = np.empty((BUCKETS, WIDTH), np.float32)
    for part in range(0, BUCKETS, 1 << 14):   # the numbers come as doubles, twice as large
        own = vectors[part:part + (1 << 14)]
        own[:] = rng.uniform(-1 / WIDTH, 1 / WIDTH, own.shape)
    output = np.zeros((WIDTH, 2), np.float32)
    done = 0
    epochs = -(-steps // len(rows)) if rows else 0
    steps = epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, counts, label = rows[i]
            share = (counts / counts.sum()).astype(np.float32)
            now = rate * (1 - done / steps)
            mean = share @ vectors[ids]
            logits = mean @ output
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = output @ p
            output -= now * np.outer(mean, p)
            vectors[ids] -= now * share[:, None] * back
            done += 1
    return vectors @ (output[:, 1] - output[:, 0])


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights learned from at most `train_rows` labelled rows, chosen by a hash of the id.

    A document with several labels counts with the largest; null labels and
    ids count as none.  Without labelled rows, as in empty tables, all weights
    are zero.
    """
    chosen = (
        labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"), FOLDS))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    # Bounded by train_rows, so it can be broadcast and the texts are not shuffled.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                pairs = [counted(_bytes(t)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality").cast(pa.int32()), pa.array([len(p[0]) for p in pairs], pa.int32()),
                     pa.array([packed(*p) for p in pairs], pa.binary())], ["doc_id", "quality", "n", "found"])

    # The driver gets and holds packed numbers, at most one for each bucket, however long the texts are.
    rows = found.mapInArrow(run, f"doc_id {kind}, quality int, n int, found binary").toArrow().sort_by("doc_id")
    weights = fit(Packed(rows))
    del rows
    pa.default_memory_pool().release_unused()   # the driver lives on beside the next stages
    return weights


def score(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, score, predicted and the struct `carried`.

    Null and empty texts have only the end feature.  Repeated rows get equal
    scores; columns outside `carry` are not read; an empty table gives no rows.
    Texts are read in portions of half a megabyte, long ones cut before white
    space, so that a long text takes little more than itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))   # one number per bucket: 1 MB

    def run(batches):
        w = shared.value
        for batch in batches:
            for rows in slices(batch):
                texts = [_bytes(t) for t in rows.column("text").to_pylist()]
                total, number = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                for ids, of in features(texts):
                    total += np.bincount(of, w[ids], len(texts))
                    number += np.bincount(of, minlength=len(texts))
                p = 1 / (1 + np.exp(-total / number))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("carried"), pa.array(p),
                     pa.array((p >= threshold).astype(np.int32))], ["doc_id", "carried", "score", "predicted"])

    rows = docs.select("doc_id", "text", carried(carry))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, carried {kinds['carried']}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS,
             threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """Train and score: doc_id, held_out, score (0 to 1), predicted and the struct `carried`.

    An empty table gives an empty result; without labels every score is 0.5.
    """
    return score(docs, train(docs, labels, train_rows), threshold, carry).withColumn("held_out", held_out(F.col("doc_id"), FOLDS))
