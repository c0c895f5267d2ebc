"""Encoding and decoding with SentencePiece BPE models, offsets kept.

Normalisation replaces the longest prefix found in the model's compiled
character map and records which source byte every normalised byte came from.
Merges follow the scores of the pieces; characters outside the vocabulary
become byte pieces.  No piece holds a space mark behind another character, so
a text falls into stretches that merge alone, and a stretch seen before is
looked up.  Every piece is projected to its span of source bytes.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.tokens import slices

CACHE_ENTRIES = 400_000   # stretches a worker remembers before it starts anew
LONG = 48                 # characters from which a heap finds the best merge

# Field numbers, piece types and the space mark of the model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
MARK = "▁"


def _fields(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Field numbers and values of one serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        elif kind == 2:
            size = number()
            yield tag >> 3, data[at:at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            yield tag >> 3, struct.unpack("<d" if size == 8 else "<f", data[at:at + size])[0]
            at += size


class CharacterMap:
    """The compiled map: a double-array trie over source bytes, and the replacements it points to."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack(f"<{size // 4}I", blob[4:4 + size]) if blob else ()
        self.texts = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest prefix of data[at:] in the map."""
        if not self.units:
            return None
        found = None
        unit, node = self.units[0], 0
        node ^= _offset(unit)
        for length, byte in enumerate(data[at:], 1):
            node ^= byte
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != byte:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = self.texts[start:self.texts.index(b"\0", start)], length
        return found


def _offset(unit: int) -> int:
    """Distance to the children, as a unit of the double array stores it."""
    return unit >> 10 << (8 if unit >> 9 & 1 else 0)


class _Stretches(dict):
    """Encoded stretches; a missing one is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, stretch: str) -> bytes:
        ids = self.encode(stretch)
        if len(stretch) <= LONG:
            self[stretch] = ids
        return ids


class PieceModel:
    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        normalizer: dict = {}
        for number, value in _fields(data):
            if number == PIECES:
                f = dict(_fields(value))
                self.pieces.append((f[1].decode(), f.get(2, 0.0), f.get(3, NORMAL)))
            elif number == TRAINER:
                trainer = dict(_fields(value))
            elif number == NORMALIZER:
                normalizer = dict(_fields(value))
        kinds = {kind for _, _, kind in self.pieces}
        if trainer.get(3, 1) != BPE or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only BPE models without user-defined or unused pieces are supported")
        self.map = CharacterMap(normalizer.get(2, b""))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.trim = bool(normalizer.get(4, 1))
        self.escape = bool(normalizer.get(5, 1))
        self.suffix_mark = bool(trainer.get(24, 0))
        if self.suffix_mark or not self.escape:
            raise ValueError("models with a trailing or no space mark are not supported")
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown_surface = trainer.get(44, " ⁇ ".encode())
        self.rank = {p: -s for p, s, kind in self.pieces if kind == NORMAL}
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.fallback = len(self.bytes) == 256
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a space mark behind another character")
        self.surface = [self._surface(i) for i in range(len(self.pieces))]
        # Bytes of source text under each piece where each mark stands for one space.
        self.width = np.array([len(s) for s in self.surface], np.int64)
        self.stretch = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.cache = _Stretches(self._encoded)

    def _surface(self, i: int) -> bytes:
        piece, _, kind = self.pieces[i]
        if kind == CONTROL:
            return b""
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return self.unknown_surface if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the source byte it comes from."""
        data = text.encode("utf-8", "surrogatepass")
        at, out, align = 0, bytearray(), []
        if self.trim:
            while (step := self._step(data, at)) and step[0] == b" ":
                at += step[1]
        if at < len(data) and self.dummy_prefix:
            out += MARK.encode()
            align += [at] * 3
        space = self.trim
        while at < len(data):
            piece, length = self._step(data, at)
            if self.trim and space:
                piece = piece.lstrip(b" ")
            if piece:
                for byte in piece:
                    new = MARK.encode() if byte == 0x20 else bytes([byte])
                    out += new
                    align += [at] * len(new)
                space = piece.endswith(b" ")
            at += length
        if self.trim:
            while out.endswith(MARK.encode()):
                at = align[-3]
                del out[-3:], align[-3:]
        align.append(at)
        return out.decode("utf-8", "surrogatepass"), np.array(align, np.int64)

    def _step(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        if at >= len(data):
            return None
        found = self.map.longest(data, at)
        if found:
            return found
        lead = data[at]
        length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at:at + length], length

    def _merged(self, stretch: str) -> list[str]:
        """Best-scored merge first, of equal ones the leftmost, until none is a piece."""
        parts, rank = list(stretch), self.rank
        if len(parts) > LONG:
            return self._merged_long(parts)
        none = float("inf")
        ranks = [rank.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = rank.get(parts[i] + parts[i + 1], none)
        return parts

    def _merged_long(self, parts: list[str | None]) -> list[str]:
        rank, n = self.rank, len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in rank]
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or parts[i] + parts[j] != piece:
                continue
            parts[i], parts[j] = piece, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (p := parts[a] + parts[b]) in rank:
                    heapq.heappush(heap, (rank[p], a, p))
        return [p for p in parts if p is not None]

    def _encoded(self, stretch: str) -> bytes:
        ids: list[int] = []
        for part in self._merged(stretch):
            own = self.ids.get(part)
            if own is not None:
                ids.append(own)
            elif self.fallback:
                ids += [self.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)   # neighbouring unknown characters share one id
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None, begin: bool = True, end: bool = True) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if self.map.units or self.trim:
            normal = self.normalize(text)[0]
        else:
            normal = (MARK if text and self.dummy_prefix else "") + text.replace(" ", MARK)
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        body = b"".join(map(self.cache.__getitem__, self.stretch.findall(normal)))
        if not self.fallback:
            body = _once(body, self.unknown)
        return (struct.pack("<I", self.begin) if begin else b"") + body + (struct.pack("<I", self.end) if end else b"")

    def spans(self, text: str | None, ids: bytes) -> np.ndarray:
        """First source byte of each id, and one more entry with the length of the text."""
        text = text or ""
        numbers = np.frombuffer(ids, np.uint32)
        size = len(text.encode("utf-8", "surrogatepass"))
        if not (self.map.units or self.trim or not self.fallback or MARK in text):
            ends = np.concatenate(([0], np.cumsum(self.width[numbers])))
            return np.clip(ends - (1 if text and self.dummy_prefix else 0), 0, size)
        normal, align = self.normalize(text)
        at, out, raw = 0, [], normal.encode("utf-8", "surrogatepass")
        for position, i in enumerate(numbers.tolist()):
            out.append(align[at])
            piece, _, kind = self.pieces[i]
            if kind == NORMAL:
                at += len(piece.encode())
            elif kind == BYTE:
                at += 1
            elif kind == UNKNOWN:   # up to where the next known piece is found
                at += 1
                following = numbers[position + 1] if position + 1 < len(numbers) else self.end
                known = self.pieces[following][0].encode() if self.pieces[following][2] == NORMAL else None
                at = raw.index(known, at) if known else len(raw)
        return np.array([*out, size], np.int64)

    def decode(self, ids: bytes) -> str:
        numbers = memoryview(ids).cast("I").tolist()
        raw = b"".join(map(self.surface.__getitem__, numbers))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_runs(numbers)
        if (self.dummy_prefix or self.trim) and text[:1] == " ":
            first = next((i for i in numbers if self.pieces[i][2] != CONTROL), None)
            if first is not None and self.pieces[first][0].startswith(MARK):
                return text[1:]
        return text

    def _decode_runs(self, numbers: list[int]) -> str:
        """Runs of byte pieces on their own; each byte outside a character becomes U+FFFD."""
        out, run = [], bytearray()
        for i in [*numbers, None]:
            if i is not None and self.pieces[i][2] == BYTE:
                run += self.surface[i]
                continue
            while run:
                for length in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:length]).decode())
                        del run[:length]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    del run[:1]
            if i is not None:
                out.append(self.surface[i].decode())
        return "".join(out)


def _once(body: bytes, unknown: int) -> bytes:
    """Unknown ids that meet where stretches join become one."""
    ids = np.frombuffer(body, np.uint32)
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] != unknown) | (ids[:-1] != unknown)
    return ids[keep].tobytes()


_models: dict[int, PieceModel] = {}


def piece_model(data: bytes) -> PieceModel:
    """One model for each worker process, so that its cache outlives a task."""
    key = hash(data)
    if key not in _models:
        _models[key] = PieceModel(data)
    return _models[key]


def encode_decode(docs: DataFrame, model: bytes) -> DataFrame:
    """Per row: doc_id, ids (little-endian unsigned 32-bit), starts (first source byte of each id,
    little-endian signed 64-bit, the text's length last) and decoded.

    model: the bytes of the model file, some 500 kB, broadcast.  Null texts
    count as empty; an empty text has only the begin and end ids.  Repeated
    rows are encoded alike; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = piece_model(shared.value)
        for batch in batches:
            for rows in slices(batch):
                texts = rows.column(1).to_pylist()
                ids = [own.encode(t) for t in texts]
                starts = [own.spans(t, i).tobytes() for t, i in zip(texts, ids)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(ids, pa.binary()), pa.array(starts, pa.binary()),
                     pa.array([own.decode(i) for i in ids], pa.string())], ["doc_id", "ids", "starts", "decoded"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, ids binary, starts binary, decoded string")
