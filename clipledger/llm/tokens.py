"""Words of many texts at once, as numpy arrays over one buffer of bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array

CHUNK_BYTES = 512 << 10   # bytes whose intermediate arrays are held at a time; a longer text is one chunk

# The white space of the contracts.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_CUT = re.compile(rb"(?<=[^\x20\x09-\x0D])[\x20\x09-\x0D]")

_KEYS = ("words, lane zero", "words, lane one.")   # of 16 bytes, one for each lane
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _A
    x = x ^ (x >> np.uint64(27))
    x = x * _B
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `size` bytes; no text is cut."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield first, i
            first, held = i, 0
        held += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def segments(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Parts of texts with about `size` bytes, and the text each part is of; longer texts are cut before white space."""
    for a, b in chunks(texts, size):
        if b > a + 1 or len(texts[a]) <= size:
            yield texts[a:b], np.arange(a, b)
            continue
        begin, text = 0, texts[a]
        while begin < len(text):
            found = _CUT.search(text, begin + size)
            end = found.start() if found else len(text)
            yield [text[begin:end]], np.array([a])
            begin = end


def slices(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `size` bytes in `column`, so that little is held as Python values."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    first = held = 0
    for i, n in enumerate(lengths):
        if i > first and held + n > size:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


class Spans:
    """Words of some texts: the joined bytes, word bounds, and the text each word is in."""

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths + 1)          # each text with one line feed behind it
        self.begins = self.ends - lengths - 1
        self.raw = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(self.raw, np.uint8)
        space = SPACE[self.data]
        edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=np.int8(1)))
        self.start, self.end = edge[::2], edge[1::2]
        self.text = np.searchsorted(self.ends, self.start, side="right")
        self.counts = np.bincount(self.text, minlength=len(texts))

    def words(self, lower: bool = False) -> pa.Array:
        """The words as bytes; `lower` puts A-Z in lower case."""
        data = self.data
        if lower:
            data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        ends = np.concatenate(([0], np.cumsum(self.end - self.start)))
        wide = ends[-1] >= 1 << 31
        return pa.Array.from_buffers(
            pa.large_binary() if wide else pa.binary(), len(self.start),
            [None, pa.py_buffer(ends.astype(np.int64 if wide else np.int32)), pa.py_buffer(data[~SPACE[data]])])

    def hashes(self, lane: int = 0, lower: bool = False) -> np.ndarray:
        """64-bit SipHash of every word; lanes have keys of their own.  Each distinct word is hashed once."""
        coded = self.words(lower).dictionary_encode()
        distinct = hash_array(coded.dictionary.to_numpy(zero_copy_only=False), hash_key=_KEYS[lane], categorize=False)
        return distinct[coded.indices.to_numpy()]
