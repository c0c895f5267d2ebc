"""Byte-level BPE through a SentencePiece model made from the vocabulary.

The ranks become a BPE model: every byte is written as one visible character,
every token is a piece scored by its negative rank, and the model normalises
nothing.  Pre-tokens are encoded on their own, since no merge crosses them; a
pre-token seen before is looked up.  Decoding maps the characters back.
"""

from __future__ import annotations

import base64
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.pieces import BPE, NORMAL, NORMALIZER, PIECES, TRAINER, UNKNOWN
from clipledger.llm.tokens import slices

CACHE_ENTRIES = 400_000   # pre-tokens a worker remembers before it starts anew
LONG = 48                 # characters up to which a pre-token is remembered

# Letters and digits that Unicode got after version 16, up to which the
# vocabulary's own encoder knows them; to it they are neither letters nor digits.
NEWER = """
    0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D
    107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F
    12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
    18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24
    1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED
    1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
NEITHER = "\ue000"   # neither letter nor digit nor white space


def _newer() -> re.Pattern:
    ranges = (r.partition("-")[::2] for r in NEWER.split())
    return re.compile("[" + "".join(
        chr(int(a, 16)) + ("-" + chr(int(b, 16)) if b else "") for a, b in ranges) + "]")


def visible() -> str:
    """256 characters, one for each byte: itself where it can be seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = dict(zip(seen, map(chr, seen)))
    for byte in range(256):
        table.setdefault(byte, chr(256 + len(table) - len(seen)))
    return "".join(table[b] for b in range(256))


def read_ranks(lines: bytes) -> list[bytes]:
    """Tokens in the order of their ranks, from lines of base64 and rank; ranks are gapless from 0."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines.splitlines()) if token}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks are not gapless from 0")
    tokens = [ranks[i] for i in range(len(ranks))]
    if {t for t in tokens if len(t) == 1} != {bytes([b]) for b in range(256)}:
        raise ValueError("a vocabulary of bytes has all 256 of them")
    return tokens


def _number(value: int) -> bytes:
    out = bytearray()
    value &= (1 << 64) - 1
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _number(number << 3 | 2) + _number(len(value)) + value
    if isinstance(value, float):
        return _number(number << 3 | 5) + struct.pack("<f", value)
    return _number(number << 3) + _number(value)


def serialised(tokens: list[bytes]) -> bytes:
    """The model file: piece 0 stands for the unknown and is never met, piece r + 1 has rank r."""
    if len(tokens) > 1 << 24:
        raise ValueError("scores are exact up to 2^24 ranks")
    table = visible()
    out = [_field(PIECES, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN))]
    for rank, token in enumerate(tokens):
        piece = token.decode("latin-1").translate(table).encode()
        out.append(_field(PIECES, _field(1, piece) + _field(2, float(-rank)) + _field(3, NORMAL)))
    # Field numbers of the format; 40 to 43 are the ids of unknown, begin, end and padding.
    out.append(_field(TRAINER, _field(3, BPE) + _field(4, len(out)) + _field(40, 0)
                      + _field(41, -1) + _field(42, -1) + _field(43, -1)))
    # No prefix, no trimming, no space mark.
    out.append(_field(NORMALIZER, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


class ByteModel:
    """Encoder and decoder of one vocabulary; pattern splits a text into pre-tokens."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens, self.table, self.newer = tokens, visible(), _newer()
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if text.isascii() or not self.newer.search(text):
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(self.newer.sub(NEITHER, text))]

    def _encoded(self, tokens: list[str]) -> list[bytes]:
        shown = [t.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table) for t in tokens]
        return [(np.array(i, np.int32) - 1).tobytes() for i in self.pieces.encode(shown, num_threads=1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        out = []
        for text in texts:
            own = self.split(text)
            lacking = list(set(own).difference(self.cache))
            known = self.cache
            if lacking:
                found = dict(zip(lacking, self._encoded(lacking)))
                if max(map(len, lacking)) <= LONG:
                    self.cache.update(found)
                else:
                    self.cache.update((t, i) for t, i in found.items() if len(t) <= LONG)
                    known = self.cache | found
            out.append(b"".join(map(known.__getitem__, own)))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_models: dict[int, ByteModel] = {}


def byte_model(model: bytes, tokens: list[bytes], pattern: str) -> ByteModel:
    """One model for each worker process, so that its cache outlives a task."""
    key = hash((model, pattern))
    if key not in _models:
        _models[key] = ByteModel(model, tokens, pattern)
    return _models[key]


def encode_bytes(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per row: doc_id, ids (array of int) and decoded (binary, the bytes that the ids stand for).

    ranks: the bytes of the rank file, some 800 kB; what is made from it is
    broadcast.  Null texts count as empty, and an empty text has no ids.  Null
    and repeated doc_ids and repeated rows are encoded alike, other columns are
    not read, an empty table gives no rows.  A task holds half a megabyte of
    text at a time; a longer text is held alone, with its ids.
    """
    tokens = read_ranks(ranks)
    shared = docs.sparkSession.sparkContext.broadcast((serialised(tokens), tokens, pattern))
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = byte_model(*shared.value)
        for batch in batches:
            for rows in slices(batch):
                ids = [np.frombuffer(i, np.int32) for i in own.encode([t or "" for t in rows.column(1).to_pylist()])]
                ends = np.cumsum([0, *map(len, ids)])
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                decoded = pa.array([own.decode(i) for i in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), listed, decoded], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, decoded binary")
