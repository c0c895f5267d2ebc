"""Lossless counts of n-grams of word numbers in counting quotient filters.

An n-gram is packed into one number of fixed width and sent through an
invertible permutation, which spreads equal beginnings evenly.  The top bits of
the result are its quotient: a filter keeps how many entries each quotient has,
in unary, and for every entry the whole remainder and a counter.  Nothing is
hashed away, so the n-gram and its exact count come back.  Filters are sorted,
a range of quotients is a filter of its own, and sorted filters merge.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from clipledger.llm.tokens import mixed

WIDEST = 42   # bits of a word number: three fill two numbers of 63 bits
_ROUNDS = tuple(np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))
_LARGE = 255  # counters from here on are kept apart, in full
_HEAD = struct.Struct("<QBBI")


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


@dataclass(frozen=True)
class Shape:
    """n-grams of `order` numbers (2 or 3) of `width` bits, as an upper and a lower number."""

    order: int
    width: int

    def __post_init__(self):
        if self.order not in (2, 3) or not 1 <= self.width <= WIDEST:
            raise ValueError(f"two or three numbers of 1 to {WIDEST} bits")

    @property
    def low(self) -> int:
        return self.width + (self.width // 2 if self.order == 3 else 0)

    @property
    def high(self) -> int:
        return self.order * self.width - self.low

    def pack(self, *ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, *rest = [i.astype(np.uint64) for i in ids]
        if self.order == 2:
            return a, rest[0]
        cut, width = np.uint64(self.width // 2), np.uint64(self.width)
        return (a << (width - cut)) | (rest[0] >> cut), ((rest[0] & _mask(int(cut))) << width) | rest[1]

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        if self.order == 2:
            return [high.astype(np.int64), low.astype(np.int64)]
        cut, width = np.uint64(self.width // 2), np.uint64(self.width)
        upper = width - cut
        middle = ((high & _mask(int(upper))) << cut) | (low >> width)
        return [x.astype(np.int64) for x in (high >> upper, middle, low & _mask(self.width))]

    def _round(self, k: int, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step that undoes itself."""
        if k % 2:
            return high, low ^ (mixed(high + _ROUNDS[k]) & _mask(self.low))
        return high ^ (mixed(low + _ROUNDS[k]) & _mask(self.high)), low

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in range(len(_ROUNDS)):
            high, low = self._round(k, high, low)
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in reversed(range(len(_ROUNDS))):
            high, low = self._round(k, high, low)
        return high, low


class CountingFilter:
    """Permuted keys in order, each once, and their counts."""

    def __init__(self, shape: Shape, high: np.ndarray, low: np.ndarray, counts: np.ndarray):
        self.shape, self.high, self.low, self.counts = shape, high, low, counts

    @classmethod
    def summed(cls, shape: Shape, high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> CountingFilter:
        """Permuted keys in any order, with repeats; without counts each is one."""
        if shape.high + shape.low <= 64:
            key = (high << np.uint64(shape.low)) | low
            order = np.argsort(key, kind="stable")   # merges what is sorted in parts
            key = key[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
        else:
            order = np.lexsort((low, high))
            new = np.ones(len(high), bool)
            new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        first = np.flatnonzero(new)
        if counts is None:
            totals = np.diff(first, append=len(order))
        else:
            totals = np.add.reduceat(counts[order], first) if len(first) else counts
        chosen = order[first]
        return cls(shape, high[chosen], low[chosen], totals.astype(np.int64))

    @classmethod
    def of(cls, shape: Shape, *ids: np.ndarray) -> CountingFilter:
        """Counts of n-grams given by their word numbers."""
        return cls.summed(shape, *shape.permute(*shape.pack(*ids)))

    @classmethod
    def merged(cls, filters: list[CountingFilter]) -> CountingFilter:
        return cls.summed(filters[0].shape, *[np.concatenate([getattr(f, name) for f in filters])
                                              for name in ("high", "low", "counts")])

    def at_least(self, count: int) -> CountingFilter:
        keep = self.counts >= count
        return CountingFilter(self.shape, self.high[keep], self.low[keep], self.counts[keep])

    def items(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Word numbers of the n-grams, and their counts."""
        return self.shape.unpack(*self.shape.restore(self.high, self.low)), self.counts

    def split(self, bits: int):
        """(number, filter) for each range of keys with the same top `bits` bits; empty ranges are left out."""
        of = self.high >> np.uint64(self.shape.high - bits)
        ends = np.append(np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)) if len(of) else []
        begin = 0
        for end in map(int, ends):
            yield int(of[begin]), CountingFilter(self.shape, *[x[begin:end] for x in (self.high, self.low, self.counts)])
            begin = end

    def _bytes_left(self, bits: int) -> int:
        return -(-(self.shape.high - bits) // 8)

    def to_bytes(self, prefix: int = 0) -> bytes:
        """The compact form.  `prefix`: top bits that all keys have in common, told to from_bytes again."""
        n, shape = len(self.high), self.shape
        bits = min(max(n.bit_length() - 1, 0), shape.high - prefix)
        inside = self.high & _mask(shape.high - prefix)
        quotient = (inside >> np.uint64(shape.high - prefix - bits)).astype(np.int64)
        unary = np.zeros(n + (1 << bits), bool)
        unary[quotient + np.arange(n)] = True       # as many ones as entries, then a zero
        rest = inside & _mask(shape.high - prefix - bits)
        large = self.counts >= _LARGE
        remainder = [_planes(rest, self._bytes_left(prefix + bits)), _planes(self.low, -(-shape.low // 8))]
        return b"".join([
            _HEAD.pack(n, prefix, bits, int(large.sum())), np.packbits(unary).tobytes(), *remainder,
            np.where(large, _LARGE, self.counts).astype(np.uint8).tobytes(), self.counts[large].astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes, shape: Shape, number: int = 0) -> CountingFilter:
        """`number`: the value of the common top bits."""
        n, prefix, bits, many = _HEAD.unpack_from(data)
        own, at = cls(shape, *[np.zeros(0, np.uint64)] * 3), _HEAD.size
        size = n + (1 << bits)
        unary = np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size)
        at += -(-size // 8)
        quotient = (np.flatnonzero(unary) - np.arange(n)).astype(np.uint64)
        width = own._bytes_left(prefix + bits)
        rest, at = _from_planes(data, at, n, width), at + n * width
        width = -(-shape.low // 8)
        low, at = _from_planes(data, at, n, width), at + n * width
        counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
        counts[counts == _LARGE] = np.frombuffer(data, "<i8", many, at + n)
        left = shape.high - prefix
        high = (np.uint64(number) << np.uint64(left)) | (quotient << np.uint64(left - bits)) | rest
        return cls(shape, high, low, counts)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest `width` bytes of each number."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_planes(data: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)
