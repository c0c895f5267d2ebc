"""Katz backoff over words and word pairs, with Good-Turing discounts.

P(w | h) is the discounted share of (h, w) among the pairs after h where that
pair was seen, and otherwise the weight of h times P(w); P(w) is the discounted
share of w where w was seen, and otherwise the mass left for unknown words,
which are one class.  The weight of h is what its discounts leave, over the
P(w) of all words never seen behind h, so that every P(. | h) sums to one.

Counts live in parts by the hash of their word, pair or context; a batch of
texts asks for the counts of its distinct words and pairs in one round, and in
a second one for the weights of the contexts from which its texts back off.
Each seen pair is owned by the first batch that has it in a training text, which
hands the pair's shares to the part of its context.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.batches import ask, inform, owners, pack, parts_for, tell
from clipledger.llm.common import held_out
from clipledger.llm.tokens import Spans, chunks, mixed
from clipledger.session import stored

BATCH_BYTES = 8 << 20   # text in a batch: larger ones ask for fewer keys in all, smaller ones hold less
LARGEST = 5          # counts up to here are discounted by Good-Turing, larger ones by as much as this one
FOLDS = 10           # one in so many rows is held out
SMOOTH = 0.1         # of the base score
START, END = np.uint64(1), np.uint64(2)   # names of the begin context and the end token


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one message; each is compressed byte plane by byte plane."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
        body = zstandard.ZstdCompressor(level=1).compress(planes)
        out.append(struct.pack("<cII", a.dtype.char.encode(), len(a), len(body)) + body)
    return b"".join(out)


def _unpacked(message: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(message):
        kind, n, size = struct.unpack_from("<cII", message, at)
        at += struct.calcsize("<cII")
        dtype = np.dtype(kind.decode())
        planes = zstandard.ZstdDecompressor().decompress(message[at:at + size], max_output_size=n * dtype.itemsize)
        at += size
        flat = np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T
        out.append(np.ascontiguousarray(flat).reshape(-1).view(dtype))
    return out


def _deltas(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


class Counted:
    """Tokens of a batch, its distinct words and pairs in order, and how often training texts have them."""

    def __init__(self, table: pa.Table):
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]
        words, owner, counts = [], [], []
        for a, b in chunks(texts):
            spans = Spans(texts[a:b])
            words.append(spans.hashes(0, lower=True))
            owner.append(spans.text + a)
            counts.append(spans.counts)
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        ends = np.cumsum(counts + 1) - 1
        self.tokens = np.full(int(counts.sum()) + len(counts), END, np.uint64)
        self.doc = np.repeat(np.arange(len(counts)), counts + 1)
        inside = np.ones(len(self.tokens), bool)
        inside[ends] = False
        self.tokens[inside] = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.context = np.empty_like(self.tokens)
        self.context[1:] = self.tokens[:-1]
        self.context[ends - counts] = START
        self.n_tokens = counts + 1
        train = ~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)[self.doc]
        pairs = mixed(mixed(self.context) * np.uint64(3) + self.tokens)
        self.words, self.word_at, self.word_counts = _distinct(self.tokens, train)
        self.pairs, self.pair_at, self.pair_counts = _distinct(pairs, train)
        self.starts = int(np.count_nonzero(train & (self.context == START)))

    def of_pairs(self, values: np.ndarray) -> np.ndarray:
        """One of the equal values that a pair's tokens have."""
        out = np.zeros(len(self.pairs), values.dtype)
        out[self.pair_at] = values
        return out


def _distinct(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, at, np.bincount(at, train, len(found)).astype(np.int64)


def _ask_counts(parts: int):
    def request(table):
        c = Counted(table)
        # The begin context is counted as a word that no text can predict.
        words = np.concatenate(([START], c.words))
        counts = np.concatenate(([c.starts], c.word_counts))
        by_word, by_pair = owners(words, parts), owners(c.pairs, parts)
        for part in np.flatnonzero((np.diff(by_word) > 0) | (np.diff(by_pair) > 0)).tolist():
            w, p = slice(*by_word[part:part + 2]), slice(*by_pair[part:part + 2])
            yield part, _packed(_deltas(words[w]), counts[w], _deltas(c.pairs[p]), c.pair_counts[p])

    return request


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct keys of all messages, each one's total, and the place of every sent key among them."""
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64), at


def _answer_counts(messages: list[bytes]) -> list[bytes]:
    """Totals of the words and pairs that were asked for, and which pairs a batch is the first to have trained on.

    The summary has how many words and pairs have each small count, the tokens and the distinct words.
    """
    sent = [_unpacked(m) for m in messages]
    words, totals, at = _totals([np.cumsum(s[0]) for s in sent], [s[1] for s in sent])
    _, pair_totals, pair_at = _totals([np.cumsum(s[2]) for s in sent], [s[3] for s in sent])
    trained = np.concatenate([s[3] for s in sent]) > 0
    first = np.zeros(len(pair_at), bool)
    where = np.flatnonzero(trained)
    first[where[np.unique(pair_at[where], return_index=True)[1]]] = True
    replies, a, b = [], 0, 0
    for s in sent:
        n, m = len(s[0]), len(s[2])
        replies.append(_packed(totals[at[a:a + n]], pair_totals[pair_at[b:b + m]], first[b:b + m].astype(np.uint8)))
        a, b = a + n, b + m
    tokens = totals[words != START]
    small = [*np.bincount(tokens[tokens <= LARGEST + 1], minlength=LARGEST + 2)[1:],
             *np.bincount(pair_totals[pair_totals <= LARGEST + 1], minlength=LARGEST + 2)[1:],
             tokens.sum(), np.count_nonzero(tokens)]
    return [*replies, struct.pack(f">{len(small)}q", *map(int, small))]


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """Share of a count that is kept, for counts 1 to LARGEST; index 0 is unused.

    Good-Turing's (r + 1) n[r + 1] / (r n[r]) where that lies between 0 and 1, else (r - 1/2) / r.
    """
    kept = [1.0]
    for r in range(1, LARGEST + 1):
        n, more = counts_of_counts[r - 1], counts_of_counts[r]
        share = (r + 1) * more / (r * n) if n else 0.0
        kept.append(share if 0 < share < 1 else (r - 0.5) / r)
    return np.array(kept)


def _lost(counts: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """What the discount takes from each count; more than nothing for every count above zero."""
    small = np.minimum(counts, LARGEST)
    return small * (1 - kept[small])


class Model:
    """What one batch knows of the model after the first round."""

    def __init__(self, counted: Counted, told: dict[int, bytes], parts: int, stats: dict):
        words = np.concatenate(([START], counted.words))
        self.c_words, self.c_pairs = np.zeros(len(words), np.int64), np.zeros(len(counted.pairs), np.int64)
        self.owned = np.zeros(len(counted.pairs), bool)
        by_word, by_pair = owners(words, parts), owners(counted.pairs, parts)
        for part, payload in told.items():
            w, p, first = _unpacked(payload)
            self.c_words[by_word[part]:by_word[part + 1]] = w
            self.c_pairs[by_pair[part]:by_pair[part + 1]] = p
            self.owned[by_pair[part]:by_pair[part + 1]] = first
        starts, self.c_words = self.c_words[0], self.c_words[1:]
        n = stats["tokens"]
        self.p_words = np.where(self.c_words > 0, (self.c_words - _lost(self.c_words, stats["word_kept"])) / max(n, 1),
                                stats["unknown"])
        c_token = self.c_words[counted.word_at]
        self.c_context = np.empty_like(c_token)
        self.c_context[1:] = c_token[:-1]
        self.c_context[counted.context == START] = starts


def _ask_weights(parts: int, stats: dict):
    def request(table, told):
        c = Counted(table)
        m = Model(c, dict(told or ()), parts, stats)
        context = c.of_pairs(c.context)
        own = np.flatnonzero(m.owned)
        keys, at = np.unique(context[own], return_inverse=True)
        seen = np.bincount(at, c.of_pairs(m.p_words[c.word_at])[own], len(keys))
        left = np.bincount(at, _lost(m.c_pairs[own], stats["pair_kept"]) / c.of_pairs(m.c_context)[own], len(keys))
        wanted = _backing_off(c, m)
        keys, wanted = mixed(keys), mixed(wanted)
        order = np.argsort(keys)
        keys, seen, left = keys[order], seen[order], left[order]
        wanted = np.sort(wanted)
        by_key, by_wanted = owners(keys, parts), owners(wanted, parts)
        for part in np.flatnonzero((np.diff(by_key) > 0) | (np.diff(by_wanted) > 0)).tolist():
            k, w = slice(*by_key[part:part + 2]), slice(*by_wanted[part:part + 2])
            yield part, _packed(_deltas(keys[k]), seen[k], left[k], _deltas(wanted[w]))

    return request


def _backing_off(c: Counted, m: Model) -> np.ndarray:
    """Contexts that training texts have, behind which a text of the batch has an unseen word."""
    return np.unique(c.context[(m.c_pairs[c.pair_at] == 0) & (m.c_context > 0)])


def _answer_weights(messages: list[bytes]) -> list[bytes]:
    sent = [_unpacked(m) for m in messages]
    keys, at = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
    seen = np.bincount(at, np.concatenate([s[1] for s in sent]), len(keys))
    left = np.bincount(at, np.concatenate([s[2] for s in sent]), len(keys))
    weight = np.log10(left) - np.log10(1 - seen)
    return [_packed(weight[np.searchsorted(keys, np.cumsum(s[3]))]) for s in sent]


def _scores(parts: int, stats: dict):
    def work(table, replies, told):
        c = Counted(table)
        m = Model(c, dict(told or ()), parts, stats)
        contexts = _backing_off(c, m)
        names = mixed(contexts)
        order = np.argsort(names)
        bounds, weights = owners(names[order], parts), np.zeros(len(names))
        for part, payload in replies.items():
            weights[order[bounds[part]:bounds[part + 1]]] = _unpacked(payload)[0]
        r = m.c_pairs[c.pair_at]
        seen = r > 0
        logp = np.log10(m.p_words)[c.word_at]
        logp[seen] = np.log10((r[seen] - _lost(r[seen], stats["pair_kept"])) / m.c_context[seen])
        back = np.flatnonzero(~seen & (m.c_context > 0))
        logp[back] += weights[np.searchsorted(contexts, c.context[back])]
        docs, n = len(c.n_tokens), stats["tokens"]
        base = np.log10((m.c_words + SMOOTH) / (n + SMOOTH * (stats["distinct"] + 1)))[c.word_at]
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": pa.array(c.n_tokens, pa.int64()),
            "n_known": pa.array(np.bincount(c.doc, m.c_words[c.word_at] > 0, docs).astype(np.int64)),
            "train_tokens": pa.array(np.full(docs, n, np.int64)),
            "base_score": pa.array(np.bincount(c.doc, base, docs)), "score": pa.array(np.bincount(c.doc, logp, docs))})

    return work


def _statistics(answers: DataFrame) -> dict:
    """Sums of the parts' summaries: a handful of numbers."""
    n = 2 * (LARGEST + 1) + 2
    number = [F.conv(F.hex(F.substring("payload", 8 * i + 1, 8)), 16, 10).cast("long") for i in range(n)]
    row = answers.where("batch = -1").agg(*[F.sum(x).alias(f"s{i}") for i, x in enumerate(number)]).first()
    v = [x or 0 for x in row]
    few, pairs, tokens, distinct = v[:LARGEST + 1], v[LARGEST + 1:-2], v[-2], v[-1]
    word_kept = discounts(few)
    # Counts above LARGEST lose as much as LARGEST does.
    lost = sum(few[r - 1] * r * (1 - word_kept[r]) for r in range(1, LARGEST + 1)) + (
        distinct - sum(few[:LARGEST])) * LARGEST * (1 - word_kept[LARGEST])
    return {"tokens": tokens, "distinct": distinct, "word_kept": word_kept, "pair_kept": discounts(pairs),
            "unknown": lost / tokens if tokens else 1.0}


def score_texts(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Tokens are the words with A-Z lower-cased and one end.  Rows whose
    crc32(doc_id) is divisible by `folds`, and null ids, are not learned from.
    Null and empty texts have the end alone; repeated rows count as often as
    they are there.  Without training rows every token is unknown.  Other
    columns are not read; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    batches = pack(rows, tag="texts", batch_bytes=BATCH_BYTES)
    parts = parts_for(batches)
    counts = stored(ask(batches, _ask_counts(parts), _answer_counts), "counts")
    stats = _statistics(counts)
    informed = inform(batches, counts, "told")
    weights = ask(informed, _ask_weights(parts, stats), _answer_weights, extra=("told",))
    return tell(informed, weights, _scores(parts, stats),
                f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                "base_score double, score double", extra=("told",))
