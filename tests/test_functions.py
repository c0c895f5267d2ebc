"""Column expressions against their plain Python meaning."""

import os
import struct
from pathlib import PurePath

import numpy as np
import pytest
from compare import rows
from pyspark.sql import functions as F

from clipledger.functions import paths
from clipledger.functions.fields import (
    accepted, as_text, backfill, entries, parse_double, parse_long, rejected, stamped_at,
    typed_or_reject, utc_stamp,
)
from clipledger.functions.signal import (
    centre_clip, downmix, quantise, riff_seconds, seconds_or_default,
)
from clipledger.functions.text import char_count, clean_sentence, retriable

NAMES = ["a.wav", "a.b.wav", ".wav", "a.", "a", "..a", "a..b", "x.mp3.mp3", "é ü.wav", "", ".a.b",
         "a\nb.wav", "a.b\nc"]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def mapped(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v")).alias("x")).collect())]


def test_path_parts(spark):
    full = [f"/d/p q/{n}" for n in NAMES if n]
    assert mapped(spark, full, paths.basename) == [os.path.basename(p) for p in full]
    assert mapped(spark, full, paths.parent_name) == ["p q"] * len(full)
    assert mapped(spark, NAMES, paths.stem) == [PurePath(n).stem for n in NAMES]
    assert mapped(spark, NAMES, paths.suffix) == [PurePath(n).suffix for n in NAMES]
    assert mapped(spark, NAMES, paths.root_of) == [os.path.splitext(n)[0] for n in NAMES]


def test_name_rules(spark):
    lit = F.lit
    assert one(spark, paths.wav_for_transcript(lit("a.mp3.mp3"))) == "a.wav.wav"
    assert one(spark, paths.wav_for_member(lit("x/a.mp3.mp3"))) == "a.mp3.wav"
    assert one(spark, paths.wav_for_engine_clip(lit("d/00000_edge_raw.mp3"))) == "00000_edge.wav"
    assert one(spark, paths.speech_name(lit("a.wav.wav"), lit("v"))) == "a_v.wav_v.wav"
    assert one(spark, paths.revoiced_name(lit("tagarela_000001.wav"), lit("v"))) == (
        "sts_v_tagarela_000001.wav")
    assert one(spark, paths.api_voice_label(lit("0123456789"))) == "elevenlabs_01234567"
    assert one(spark, paths.cloned_voice_label(lit("/x/" + "s" * 30 + ".wav"))) == (
        "xtts_v2_" + "s" * 20)
    assert one(spark, paths.cloned_voice_label(lit("s.wav"), lit("own"))) == "own"
    assert one(spark, paths.cloned_voice_label(lit("s.wav"), lit(""))) == "xtts_v2_s"
    assert one(spark, paths.voice_slug(lit("a b  c"))) == "a_b__c"
    assert one(spark, paths.target_path("root", lit("v"), lit("f.wav"))) == "root/v/f.wav"


def test_sequence_names(spark):
    numbers = [0, 7, 999_999, 1_000_000, 12_345_678]
    names = mapped(spark, numbers, paths.sequence_name, "bigint")
    assert names == [f"tagarela_{n:06d}.wav" for n in numbers]
    assert mapped(spark, names, paths.sequence_index) == numbers
    assert mapped(spark, ["tagarela_x.wav", "a.wav", "tagarela_1.mp3"], paths.sequence_index) == [
        None] * 3


def test_clean_sentence(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = ["  a b ", "\t\n", "", "x", " é​ ", "a\n", "﻿ a", *[f"{b}a{b}b{b}" for b in blanks]]
    assert mapped(spark, texts, clean_sentence) == [t.strip() for t in texts]
    assert mapped(spark, ["é", "😀a", ""], char_count) == [1, 2, 0]


def test_retriable(spark):
    texts = ["HTTP 429", "Rate limit", "generated", "boom", ""]
    assert mapped(spark, texts, retriable) == ["429" in t or "rate" in t.lower() for t in texts]


LONGS = ["5", " 5 ", "+5", "-0", "1_000", "1__0", "_1", "1.5", "xx", "5x", " ", "1e3", "0x1",
         "9223372036854775807"]
DOUBLES = ["0.75", " 1 ", "1.", ".5", "1e-5", "1E+2", "inf", "-Infinity", "1.5f", "1.5d", "0x1p3",
           "1_0.5", "1._5", "", " ", "e1", "+.5e1", "--1"]


def read(kind, text):
    try:
        return kind(text)
    except ValueError:
        return None


def test_numbers_read_like_python(spark):
    assert mapped(spark, LONGS, parse_long) == [read(int, t) for t in LONGS]
    assert mapped(spark, DOUBLES, parse_double) == [read(float, t) for t in DOUBLES]
    assert str(mapped(spark, ["nan"], parse_double)[0]) == "nan"


def test_typed_or_reject(spark):
    raw = spark.createDataFrame(
        [("a", "real", None, None, "0"), ("b", "fake", "rvc", "xx", ""), ("c", "fake", "", "1.5", "1.5")],
        "filename string, label string, method string, index_rate string, pitch string")
    typed = typed_or_reject(raw)
    assert rows(accepted(typed), "filename", "method", "index_rate", "pitch", "source_file") == [
        ("a", "", None, 0, "")]
    assert rows(rejected(typed), "filename", "reject") == [("b", "index_rate"), ("c", "pitch")]
    assert accepted(typed_or_reject(raw.drop("label"))).count() == 0


def test_backfill(spark):
    df = spark.createDataFrame(
        [("real", "", ""), ("real", "tagarela", "t"), ("fake", "", "t"), ("fake", "rvc", "")],
        "label string, method string, generated_at string")
    assert [tuple(r) for r in backfill(df).select(
        "label", "method", "generated_at", "changed").collect()] == [
        ("real", "common_voice", "unknown", True), ("real", "tagarela", "t", False),
        ("fake", "", "t", False), ("fake", "rvc", "unknown", True)]


def test_entries_and_text(spark):
    df = spark.createDataFrame([("a.wav", "v", "s.wav")],
                               "filename string, voice_model string, source_file string")
    made = entries(df, "fake", "rvc", generated_at="T").unionByName(entries(df, "fake", "tts"))
    assert rows(as_text(made)) == [
        ("a.wav", "", "fake", "rvc", "v", "s.wav", "rmvpe", "0.75", "0.33", "0.25", "128", "0", "T"),
        ("a.wav", "", "fake", "tts", "v", "s.wav", "", "", "", "", "", "", "")]


def test_stamps(spark):
    at = F.lit("2026-03-10 01:02:03").cast("timestamp")
    assert one(spark, utc_stamp(at)) == "2026-03-10T01:02:03Z"
    assert len(one(spark, utc_stamp())) == 20
    assert mapped(spark, ["2026-03-10T01:02:03Z", "", "unknown"],
                  lambda c: stamped_at(c).isNotNull()) == [True, False, False]


def test_quantise_like_numpy(spark):
    rng = np.random.default_rng(0)
    signal = np.concatenate([
        rng.uniform(-1.2, 1.2, 500), [1.0, -1.0, 2.0, -2.0, -1e-5, 1e-9, 0.0, 0.99999]]
    ).astype(np.float32)
    loud = signal * np.float32(32767)
    want = np.trunc(np.minimum(np.maximum(loud, -32768), 32767)).astype("int16")
    got = mapped(spark, [signal.tolist(), [], [float("nan")]], quantise, "array<float>")
    assert got == [want.tolist(), [], [0]]


@pytest.mark.parametrize("channels", [1, 2, 3, 6])
def test_downmix_like_numpy(spark, channels):
    frames = np.random.default_rng(1).uniform(-1, 1, (300, channels)).astype(np.float32)
    got = mapped(spark, [frames.tolist()], downmix, "array<array<float>>")[0]
    assert np.array_equal(np.array(got, np.float32), frames.mean(axis=1))


@pytest.mark.parametrize("length, rate, first, count", [
    (100, 1, 20, 60), (30, 1, 0, 30), (61, 1, 0, 60), (64, 1, 2, 60), (0, 1, 0, 0), (400, 2, 140, 120)])
def test_centre_clip(spark, length, rate, first, count):
    got = mapped(spark, [list(range(length))], lambda c: centre_clip(c, rate), "array<int>")[0]
    assert got == list(range(first, first + count))


def header(frames=100, rate=16000, channels=1, riff=b"RIFF", data=b"data", fmt=1):
    size = frames * channels * 2
    return riff + struct.pack("<I", 36 + size) + b"WAVEfmt " + struct.pack(
        "<IHHIIHH", 16, fmt, channels, rate, rate * channels * 2, channels * 2, 16) + data + struct.pack(
        "<I", size)


def test_riff_seconds(spark):
    cases = [header(32000), header(8000, 8000, 2), header(rate=0), header(riff=b"RIFX"),
             header(data=b"LIST"), header(fmt=3), b"", b"RIFF", header(3_000_000_00)]
    got = mapped(spark, cases, lambda c: seconds_or_default(riff_seconds(c)), "binary")
    assert got == [2.0, 1.0, 10.7, 10.7, 10.7, 10.7, 10.7, 10.7, 18750.0]


def test_riff_chunks_are_walked(spark):
    def chunk(name, body):
        return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)

    def fmt(tag, tail=b""):
        return chunk(b"fmt ", struct.pack("<HHIIHH", tag, 2, 8000, 32000, 4, 16) + tail)

    pcm = bytes.fromhex("0100000000001000800000AA00389B71")
    data = b"data" + struct.pack("<I", 4 * 24000)
    extensible = fmt(0xFFFE, struct.pack("<HHI", 22, 16, 3) + pcm)
    bodies = [fmt(1) + chunk(b"LIST", b"INFO" * 9) + data, chunk(b"JUNK", b"odd") + fmt(1) + chunk(b"fact", b"x" * 7) + data,
              extensible + data, fmt(0xFFFE, struct.pack("<HHI", 22, 16, 3) + b"\3" + pcm[1:]) + data,
              data + fmt(1), fmt(1) + chunk(b"LIST", b"abc")]
    got = mapped(spark, [b"RIFF\0\0\0\0WAVE" + b for b in bodies], lambda c: seconds_or_default(riff_seconds(c)), "binary")
    assert got == [3.0, 3.0, 3.0, 10.7, 10.7, 10.7]


def test_riff_of_many_chunks(spark):
    """More chunks than the first walk has steps for, and a long file whose samples come early."""
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16)
    data = b"data" + struct.pack("<I", 4 * 24000)
    bodies = [b"JUNK\0\0\0\0" * 100 + fmt + data, fmt + data + b"x" * 4_000_000, fmt + b"JUNK\0\0\0\0" * 40]
    got = mapped(spark, [b"RIFF\0\0\0\0WAVE" + b for b in bodies], lambda c: seconds_or_default(riff_seconds(c)), "binary")
    assert got == [3.0, 3.0, 10.7]


def test_riff_content_is_computed_once(spark):
    """The content may be a long expression; a step that names it a hundred times must not compute it as often."""
    given = spark.createDataFrame([(header(32000).hex(),), ("zz",), (None,)], "digits string")
    got = given.select(riff_seconds(F.unhex(F.lower("digits"))).alias("s"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unhex(") == 1 and plan.count("aggregate(") <= 3
    assert [r["s"] for r in got.collect()] == [2.0, None, None]


def test_riff_with_a_chunk_beyond_two_gigabytes(spark):
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16)
    bodies = [fmt + b"LIST" + struct.pack("<I", 0xFFFFFFFF) + b"abc", fmt + b"data" + struct.pack("<I", 0xFFFFFFFC)]
    got = mapped(spark, [b"RIFF\0\0\0\0WAVE" + b for b in bodies], riff_seconds, "binary")
    assert got == [None, 0x3FFFFFFF / 8000]
