"""SentencePiece against its library, and the language model against a plain one."""

import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from brute import lower, words

from clipledger.llm import katz
from clipledger.llm.katz import score_texts
from clipledger.llm.pieces import CharacterMap, PieceModel, encode_decode

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_encodes_and_decodes_like_the_library(docs, rows, model, library):
    got = encode_decode(docs, model).collect()
    expected = []
    for r in rows:
        ids = library.encode(r[1] or "", add_bos=True, add_eos=True)
        expected.append((r[0], struct.pack(f"<{len(ids)}I", *ids), library.decode(ids)))
    assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in got) == Counter(expected)


def test_random_texts_and_ids(model, library):
    own, rng = PieceModel(model), random.Random(1)
    parts = ["▁", " ", "  ", "a", "the", " the", "\n", "\t", "é", "日", "😀", "\x00", "　", "ing", " " * 20, "a" * 60, "́"]
    for _ in range(2_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids = own.encode(text)
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert list(memoryview(ids).cast("I")) == expected and own.decode(ids) == library.decode(expected)
        some = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259)]) for _ in range(8)]
        assert own.decode(struct.pack("<8I", *some)) == library.decode(some)


def test_spans_cover_the_source(model):
    own = PieceModel(model)
    for text in ("", "  two  spaces é", "a▁b 日😀", "x" * 100, "\x00 ab"):
        raw, ids = text.encode(), own.encode(text)
        starts = own.spans(text, ids).tolist()
        numbers = list(memoryview(ids).cast("I"))
        assert starts[0] == 0 and starts[-1] == len(raw) and starts == sorted(starts)
        for n, (i, a, b) in enumerate(zip(numbers, starts, starts[1:])):
            piece, _, kind = own.pieces[i]
            if kind == 1:   # the mark put before the text has no source
                assert raw[a:b].decode().replace(" ", "▁") == (piece[1:] if n == 1 else piece)
            elif kind == 6:
                assert raw[a:b] == own.surface[i]


def _double_array(words_: dict[bytes, bytes]) -> bytes:
    """A compiled map: children of a node with offset o stand at o ^ byte, values behind byte 0."""
    texts, places = b"", {}
    for k, v in words_.items():
        places[k], texts = len(texts), texts + v + b"\0"
    prefixes = sorted({k[:i] for k in words_ for i in range(len(k) + 1)}, key=len)
    base = {p: 256 * (i + 1) for i, p in enumerate(prefixes)}
    units = [0] * (256 * (len(prefixes) + 2))
    at = {b"": 0}
    for p in prefixes:
        if p:
            at[p] = base[p[:-1]] ^ p[-1]
        distance = at[p] ^ base[p]
        wide = not distance >> 8 << 8 ^ distance
        stored = (distance >> 8) << 10 | 1 << 9 if wide else distance << 10
        units[at[p]] = stored | (0x100 if p in words_ else 0) | (p[-1] if p else 0)
        if p in words_:
            units[base[p]] = places[p] | 0x80000000
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + texts


def test_longest_prefix_of_the_character_map(model):
    entries = {"ﬁ".encode(): b"fi", b"a": b"b", b"ab": b"XY", b"abcd": b"long", "　".encode(): b" ", b"\t": b""}
    own = PieceModel(model)
    own.map = CharacterMap(_double_array(entries))
    assert own.map.longest(b"abcx", 0) == (b"XY", 2) and own.map.longest(b"xabcd", 1) == (b"long", 4)
    assert own.map.longest(b"zz", 0) is None
    text = "ﬁ abc\t　a"
    normal, align = own.normalize(text)
    assert normal == "▁fi▁XYc▁b"
    assert align.tolist() == [0, 0, 0, 0, 0, 3, 3, 3, 4, 4, 6, 8, 8, 8, 11, 12]
    ids = own.encode(text)
    assert own.decode(ids) == "fi XYc b" and own.spans(text, ids)[-1] == len(text.encode())


def _plain(rows, folds):
    train = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % folds]
    tokens = lambda t: [*words(lower(t)), None]
    word, pair, context = Counter(), Counter(), Counter()
    for r in train:
        ws = tokens(r[1])
        word.update(ws)
        pair.update(zip(["", *ws], ws))
        context.update(["", *ws[:-1]])
    n = sum(word.values())

    def kept(counter):
        many = Counter(counter.values())
        return katz.discounts([many[i] for i in range(1, 7)])

    word_kept, pair_kept = kept(word), kept(pair)
    cut = lambda r, k: r - min(r, 5) * (1 - k[min(r, 5)])
    p = {w: cut(r, word_kept) / n for w, r in word.items()}
    unknown = 1 - sum(p.values())
    seen, left = defaultdict(float), defaultdict(lambda: 1.0)
    for (h, w), r in pair.items():
        seen[h] += p[w]
        left[h] -= cut(r, pair_kept) / context[h]

    def prob(h, w):
        if pair[h, w]:
            return cut(pair[h, w], pair_kept) / context[h]
        return p.get(w, unknown) * (left[h] / (1 - seen[h]) if context[h] else 1)

    return tokens, word, n, prob


def test_katz_scores(docs, rows, small_batches):
    tokens, word, n, prob = _plain(rows, 10)
    for h in ["", *list(word)[:8]]:
        if h is not None:
            assert sum(prob(h, w) for w in word) + prob(h, "\0") == pytest.approx(1, abs=1e-9)
    expected = defaultdict(list)
    for r in rows:
        ws = tokens(r[1])
        expected[r[0], len(ws)].append((
            sum(word[w] > 0 for w in ws), sum(math.log10((word[w] + 0.1) / (n + 0.1 * (len(word) + 1))) for w in ws),
            sum(math.log10(prob(h, w)) for h, w in zip(["", *ws], ws))))
    got = defaultdict(list)
    for r in score_texts(docs, 10).collect():
        assert r["train_tokens"] == n
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        got[r["doc_id"], r["n_tokens"]].append((r["n_known"], r["base_score"], r["score"]))
    assert set(got) == set(expected)
    for key, own in expected.items():
        for a, b in zip(sorted(own), sorted(got[key])):
            assert a == pytest.approx(b, rel=1e-8)


def test_without_training_rows(docs, rows, none, model):
    got = score_texts(docs.where("doc_id is null"), 10).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"]) for r in got} == {(0, 0, 0.0)}
    assert score_texts(none).count() == 0
    assert encode_decode(none, model).count() == 0


def test_totals_beyond_32_bits():
    import numpy as np

    key, first = np.array([5], np.uint64), np.array([9], np.uint64)
    message = katz._packed(key, np.array([3_000_000_000]), first, np.array([4_000_000_000]))
    replies = katz._answer_counts([message, message])
    for reply in replies[:2]:
        words_, pairs, _ = katz._unpacked(reply)
        assert words_.tolist() == [6_000_000_000] and pairs.tolist() == [8_000_000_000]
    assert struct.unpack(">14q", replies[2])[-2:] == (6_000_000_000, 1)
