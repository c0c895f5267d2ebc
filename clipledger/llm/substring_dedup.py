"""Repeated word sequences by recompression.

Every word has a 64-bit name.  Three rounds rename runs and pairs: round one
gives two equal words in a row, and no more than two, one name; round two names
pairs of single words, round three pairs of up to four words, where the left
name falls into one half of the names and the right one into the other.  A new
name is a hash of the two it replaces, so all tasks agree on it and equal
sequences get equal names inside, wherever they stand; only at its borders can
a sequence be parsed differently, and then by no more than 2 + 1 + 2 words on
either side.  The names in the middle ten words of a 20-word window are thus
fixed by the window, and the smallest of them (by hash) anchors it.

Round by round over the whole table: batches ask which anchors, each with the
words around it, are found anywhere else; the windows on shared anchors ask, by
96 bits of all their words, whether the same sequence starts earlier; those
that do cover the words to remove.  The parts that answer are dealt out by hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.batches import ask, inform, owners, pack, parts_for, tell
from clipledger.llm.common import carried
from clipledger.llm.tokens import Spans, chunks, mixed
from clipledger.session import stored

WINDOW = 20              # words
_RUN, _PAIR, _HALF = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
_LAST_ID = (1 << 63) - 1
_MESSAGE = np.dtype([("high", "<u8"), ("low", "<u4"), ("doc", "<i8"), ("at", "<u4")])


def _margin(window: int) -> int:
    """Words at either border of a window whose names are not fixed by it: 5 of 20."""
    if window < 18:
        raise ValueError("windows of fewer than 18 words may hold no whole name")
    return 5


def rounds(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names after the three rounds, and the position of the first word of each.

    words, text: name of each word, and the text it is in.
    """
    names, first = words, np.arange(len(words))
    # Round one: runs of exactly two.
    if len(names):
        same = np.zeros(len(names) + 1, bool)
        same[1:-1] = (names[1:] == names[:-1]) & (text[1:] == text[:-1])
        two = same[1:-1] & ~same[:-2] & ~same[2:] if len(names) > 1 else np.zeros(0, bool)
        names, first = _merged(names, first, np.flatnonzero(two), _RUN)
    for span in (2, 4):
        if len(names) < 2:
            break
        length = np.diff(first, append=len(words))
        half = mixed(names ^ (_HALF * np.uint64(span))) >> np.uint64(63)
        pair = (half[:-1] == 0) & (half[1:] == 1) & (length[:-1] + length[1:] <= span) & (
            text[first[1:]] == text[first[:-1]])
        names, first = _merged(names, first, np.flatnonzero(pair), _PAIR * np.uint64(span))
    return names, first


def _merged(names, first, left, salt):
    """Replace the names at `left` and behind by one; no two of these pairs overlap."""
    names = names.copy()
    names[left] = mixed(mixed(names[left] + salt) * np.uint64(3) + names[left + 1])
    keep = np.ones(len(names), bool)
    keep[left + 1] = False
    return names[keep], first[keep]


class Parsed:
    """Words, names and anchored windows of one batch."""

    def __init__(self, table: pa.Table, window: int):
        self.window = window
        self.texts = [(t or "").encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]
        ids = table.column("id").to_numpy()
        names, owner, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in chunks(self.texts):
            spans = Spans(self.texts[a:b])
            names.append(spans.hashes(0))
            owner.append(spans.text + a)
            counts.append(spans.counts)
        words = np.concatenate(names)
        self.text = np.concatenate(owner)
        self.counts = np.concatenate(counts)
        self.begins = np.cumsum(self.counts) - self.counts
        self.ids = ids
        n = len(self.text)
        # Windows that lie inside one text, by the position of their first word.
        self.at = np.flatnonzero(self.text[: n - window + 1] == self.text[window - 1:]) if n >= window else np.zeros(0, np.int64)
        names, first = rounds(words, self.text)
        after = np.append(first[1:], n)
        edge = _margin(window)
        low = np.searchsorted(first, self.at + edge)
        high = np.searchsorted(after, self.at + window - edge, side="right")   # names of [low, high) lie inside
        order = mixed(names)
        best, choice = order[np.minimum(low, len(order) - 1)] if n else order, low.copy()
        for step in range(1, int((high - low).max(initial=0))):
            there = low + step
            value = order[np.minimum(there, len(order) - 1)]
            better = (there < high) & (value < best)
            best = np.where(better, value, best)
            choice = np.where(better, there, choice)
        # The anchor and the words around it, all of them inside its windows.
        self.anchors, self.anchor_of = np.unique(choice, return_inverse=True)
        self.sums, self.back = self._prefix(words, 0)
        lead, tail = first[self.anchors] - edge, after[self.anchors] + edge
        self.context = _digest(self.sums, self.back, lead, tail)

    def _prefix(self, words: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums from which the hash of any word sequence follows, and what undoes its place."""
        base = np.uint64(0x9E6C63D0876A9A47 + 2 * lane)
        power, back = (np.full(len(words) + 1, b, np.uint64) for b in (base, np.uint64(pow(int(base), -1, 1 << 64))))
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mixed(words) * power[:-1], out=sums[1:])
        return sums, back

    def window_digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows at some positions, from independent hashes of their words."""
        high = _digest(self.sums, self.back, at, at + self.window)
        if not len(at):
            return high, high
        words = np.concatenate([Spans(self.texts[a:b]).hashes(1) for a, b in chunks(self.texts)])
        return high, _digest(*self._prefix(words, 1), at, at + self.window)


def _digest(sums, back, start, end):
    return mixed((sums[end] - sums[start]) * back[start])


def _anchor_message(parsed: Parsed):
    """Distinct anchor contexts of a batch in order, which of them repeat in it, and each anchor's place among them."""
    keys, place, counts = np.unique(parsed.context, return_inverse=True, return_counts=True)
    return keys, counts > 1, place


def _shared_anchors(parsed: Parsed, parts: int, replies: dict[int, bytes]) -> np.ndarray:
    keys, repeats, place = _anchor_message(parsed)
    shared = repeats.copy()
    bounds = owners(keys, parts)
    for part, payload in replies.items():
        a, b = bounds[part], bounds[part + 1]
        shared[a:b] |= np.unpackbits(np.frombuffer(payload, np.uint8), count=b - a).astype(bool)
    return shared[place]


def _windows_asked(parsed: Parsed, shared: np.ndarray):
    """Windows on shared anchors: positions, whether the same sequence starts earlier in the batch, and the
    message of those that do not, sorted."""
    at = parsed.at[shared[parsed.anchor_of]]
    high, low = parsed.window_digests(at)
    rows = np.zeros(len(at), _MESSAGE)
    text = parsed.text[at]
    rows["high"], rows["low"], rows["doc"] = high, (low >> np.uint64(32)).astype(np.uint32), parsed.ids[text]
    rows["at"] = at - parsed.begins[text]
    order = np.lexsort((rows["at"], rows["doc"], rows["low"], rows["high"]))
    rows = rows[order]
    earlier = _starts_earlier(rows)
    return at[order], earlier, rows[~earlier]


def _starts_earlier(rows: np.ndarray) -> np.ndarray:
    """For sorted rows: whether the first row with the same digest has another (doc, at), which is then smaller."""
    if not len(rows):
        return np.zeros(0, bool)
    new = np.ones(len(rows), bool)
    new[1:] = (rows["high"][1:] != rows["high"][:-1]) | (rows["low"][1:] != rows["low"][:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (rows["doc"] != rows["doc"][first]) | (rows["at"] != rows["at"][first])


def _answer_anchors(messages: list[bytes]) -> list[bytes]:
    """For each key whether another batch has it too."""
    keys = [np.frombuffer(m, np.uint64) for m in messages]
    together = np.concatenate(keys)
    _, place, counts = np.unique(together, return_inverse=True, return_counts=True)
    shared = (counts > 1)[place]
    ends = np.cumsum([len(k) for k in keys])
    return [np.packbits(shared[e - len(k):e]).tobytes() for k, e in zip(keys, ends)]


def _answer_windows(messages: list[bytes]) -> list[bytes]:
    """For each window whether another batch has the same sequence earlier."""
    rows = [np.frombuffer(m, _MESSAGE) for m in messages]
    together = np.concatenate(rows)
    order = np.lexsort((together["at"], together["doc"], together["low"], together["high"]))
    earlier = np.zeros(len(together), bool)
    earlier[order] = _starts_earlier(together[order])
    ends = np.cumsum([len(r) for r in rows])
    return [np.packbits(earlier[e - len(r):e]).tobytes() for r, e in zip(rows, ends)]


def remove_repeats(docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = (),
                   rejoin: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text (words joined by one space) and the struct `carried`.

    Without `rejoin`, a text that loses nothing also keeps its white space.
    A word goes if a `window`-word sequence over it also starts earlier, in a
    smaller doc_id or before it in the same document.  Null ids count as the
    largest id; rows that repeat an id and its text are the same document, and
    stay or go together.  Null, empty and shorter texts keep all their words.
    Columns outside `carry` are not read; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("id"), "text",
        carried(carry))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    batches = pack(rows, tag="texts")
    parts = parts_for(batches)

    def ask_anchors(table):
        keys, _, _ = _anchor_message(Parsed(table, window))
        bounds = owners(keys, parts)
        for part in np.flatnonzero(np.diff(bounds)).tolist():
            yield part, keys[bounds[part]:bounds[part + 1]].tobytes()

    anchors = ask(batches, ask_anchors, _answer_anchors)
    # Some bits for each anchor, so a small part of the text they come from.
    informed = inform(batches, stored(anchors, "shared-anchors"), "told")

    def ask_windows(table, bits):
        parsed = Parsed(table, window)
        _, _, message = _windows_asked(parsed, _shared_anchors(parsed, parts, dict(bits or ())))
        bounds = owners(message["high"], parts)
        for part in np.flatnonzero(np.diff(bounds)).tolist():
            yield part, message[bounds[part]:bounds[part + 1]].tobytes()

    def remove(table, replies, bits):
        parsed = Parsed(table, window)
        at, earlier, message = _windows_asked(parsed, _shared_anchors(parsed, parts, dict(bits or ())))
        bounds = owners(message["high"], parts)
        elsewhere = np.zeros(len(message), bool)
        for part, payload in replies.items():
            a, b = bounds[part], bounds[part + 1]
            elsewhere[a:b] = np.unpackbits(np.frombuffer(payload, np.uint8), count=b - a).astype(bool)
        gone = earlier.copy()
        gone[~earlier] = elsewhere
        cover = np.zeros(len(parsed.text) + 1, np.int32)
        np.add.at(cover, at[gone], 1)
        np.add.at(cover, at[gone] + window, -1)
        removed = np.cumsum(cover[:-1]) > 0
        kept, n_removed = [], []
        for i, raw in enumerate(parsed.texts):
            a = parsed.begins[i]
            own = removed[a:a + parsed.counts[i]]
            words = raw.split()
            n_removed.append(int(own.sum()))
            if n_removed[-1]:
                words = [w for w, r in zip(words, own.tolist()) if not r]
            kept.append(b" ".join(words) if rejoin or n_removed[-1] else raw)
        return pa.table({
            "doc_id": table.column("doc_id"), "n_words": pa.array(parsed.counts, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()), "carried": table.column("carried")})

    answers = ask(informed, ask_windows, _answer_windows, extra=("told",))
    return tell(informed, answers, remove, f"doc_id {kinds['doc_id']}, n_words bigint, n_removed bigint, "
                f"kept_text string, carried {kinds['carried']}", extra=("told",))
