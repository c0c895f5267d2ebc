"""Byte-level BPE against the vocabulary's own library."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from clipledger.llm.byte_pieces import ByteModel, encode_bytes, read_ranks, serialised, visible

NAMES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


def ranks_of(name):
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def library(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_of(name).splitlines())}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=NAMES)
def pair(request):
    tokens = read_ranks(ranks_of(request.param))
    return ByteModel(serialised(tokens), tokens, public_tokenizers.PATTERN), library(request.param)


def ids(own, text):
    return [i for i in memoryview(own.encode([text])[0]).cast("i")]


def test_bytes_are_visible():
    table = visible()
    assert len(set(table)) == 256 and all(c.isprintable() and not c.isspace() for c in table)


def test_every_code_point(pair):
    own, theirs = pair
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 2_000):
        # next to a letter, a digit, a sign, white space and itself
        text = "".join(f"a{c}a1{c}1#{c}#{c} {c}{c}\n" for c in points[i:i + 2_000])
        assert ids(own, text) == theirs.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeth 's\n\t1é日▁Ġ\x00\x1c\x85\xa0"))))
def test_any_text(pair, text):
    own, theirs = pair
    got = ids(own, text)
    assert got == theirs.encode_ordinary(text)
    assert own.decode(memoryview(own.encode([text])[0]).cast("i")) == text.encode()


def test_long_pretokens(pair):
    own, theirs = pair
    for text in ("z" * 30_000, "ab" * 9_000 + " " * 5_000, "\n" * 4_000 + "x", "é" * 3_000, "<unk><s>\x00"):
        assert ids(own, text) == theirs.encode_ordinary(text)
    assert max(map(len, own.cache)) <= 48


def test_table(docs, rows):
    name = NAMES[0]
    theirs = library(name)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"], bytes(r["decoded"]))
                 for r in encode_bytes(docs, ranks_of(name), public_tokenizers.PATTERN).collect())
    assert got == sorted((r[0] is None, r[0] or 0, theirs.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows)


def test_query(spark, docs, rows, tmp_path):
    from clipledger.llm.queries import op12_byte_bpe

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    theirs = library(NAMES[0])
    want = []
    for r in rows:
        i = theirs.encode_ordinary(r[1] or "")
        want.append((r[0], len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    got = op12_byte_bpe(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())


def test_no_rows(none):
    assert encode_bytes(none, ranks_of(NAMES[0]), public_tokenizers.PATTERN).count() == 0


def test_refused_vocabularies():
    lines = ranks_of(NAMES[0]).splitlines()
    with pytest.raises(ValueError, match="gapless"):
        read_ranks(b"\n".join(lines[:50] + lines[51:]))
    with pytest.raises(ValueError, match="256"):
        read_ranks(b"\n".join(lines[:100]))
