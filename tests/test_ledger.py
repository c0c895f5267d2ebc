"""Merging, locating, pairing, transcripts and whole plans."""

from compare import rows
from pyspark.sql import functions as F

from clipledger.functions.fields import entries
from clipledger.operators.locate import inventory, locate_files, real_fake_pairs, reconcile
from clipledger.operators.merge import append_union, incoming_entries, manifest_merge, new_entries
from clipledger.operators.stats import done_counts, engine_counts, label_counts
from clipledger.operators.transcripts import match_transcripts, unmatched_clips
from clipledger.plans.conversion import conversion_plan, merged_manifest, run_conversion
from clipledger.plans.corpus import engine_entries, new_samples, sample_entries, speech_plan
from clipledger.plans.flatten import flatten_plan
from clipledger.plans.revoicing import run_revoicing
from clipledger.schema import LEDGER, MANIFEST_FIELDS
from clipledger.sources.voices import configured_voices


def ledger(spark, *items):
    """Ledger rows from (filename, label, method, voice, source)."""
    base = [(i, f, "", lab, m, v, s, "", None, None, None, None, None, "")
            for i, (f, lab, m, v, s) in enumerate(items)]
    return spark.createDataFrame(base, LEDGER)


def offer(spark):
    clips = spark.createDataFrame([("a.wav",), ("b.wav",), ("b.wav",)], "filename string")
    done = spark.createDataFrame(
        [("v", "a.wav", "/r/a.wav", 0), ("v", "b.wav", "/r/b.wav", 0), ("v", "b.wav", "/r/b.wav", 0),
         ("w", "a.wav", "/r/a.wav", 1)],
        "voice string, filename string, source_path string, ord int")
    return incoming_entries(clips, done, "rvc", "T")


def test_merge_is_insert_only(spark):
    have = ledger(spark, ("a.wav", "real", "common_voice", "", ""), ("a.wav", "fake", "tts", "v", "x"))
    merged = manifest_merge(have, offer(spark), "part", "ord", "origin")
    assert [tuple(r) for r in merged.orderBy("entry_seq").select(
        "entry_seq", "filename", "label", "method", "voice_model", "source_file", "pitch",
        "generated_at").collect()] == [
        (0, "a.wav", "real", "common_voice", "", "", None, ""),
        (1, "a.wav", "fake", "tts", "v", "x", None, ""),
        (2, "b.wav", "real", "", "", "", None, ""),
        (3, "b.wav", "fake", "rvc", "v", "b.wav", 0, "T"),
        (4, "a.wav", "fake", "rvc", "w", "a.wav", 0, "T"),
    ]
    assert new_entries(merged, offer(spark), "part", "ord", "origin").count() == 0
    assert manifest_merge(ledger(spark), offer(spark), "part", "ord", "origin").count() == 5
    assert rows(label_counts(merged)) == [(2, 3)]
    assert ("rvc", "v", 1) in rows(done_counts(merged))
    assert rows(engine_counts(merged.where("label = 'fake'"))) == [("v", 2), ("w", 1)]


def test_union_keeps_repeats(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert append_union(df, df.select("y", "x"), df).count() == 3


FILES = ["real/a.wav", "backup/real/b.wav", "real/b.wav", "real_tagarela/b.wav", "real_tagarela/t.wav",
         "old/c.wav", "fake/v/a.wav", "fake/w/a.wav", "z/misc/n.wav"]


def files(spark, paths=FILES):
    return inventory(spark.createDataFrame([(p,) for p in paths], "path string"))


def test_locate(spark):
    have = ledger(
        spark, ("a.wav", "real", "", "", ""), ("b.wav", "real", "", "", ""), ("t.wav", "real", "", "", ""),
        ("c.wav", "real", "", "", ""), ("a.wav", "fake", "rvc", "w", "a.wav"),
        ("a.wav", "fake", "rvc", "other", "a.wav"), ("n.wav", "fake", "rvc", "v", ""),
        ("gone.wav", "fake", "rvc", "v", ""))
    got = locate_files(have.select("entry_seq", "filename", "label", "voice_model"), files(spark))
    assert [p for _, p in sorted(rows(got, "entry_seq", "path"))] == [
        "real/a.wav", "backup/real/b.wav", "real_tagarela/t.wav", "old/c.wav", "fake/w/a.wav",
        "fake/v/a.wav", "z/misc/n.wav", None]


def test_reconcile_and_pairs(spark):
    have = ledger(spark, ("a.wav", "real", "", "", ""), ("a.wav", "fake", "rvc", "v", "a.wav"),
                  ("q.wav", "fake", "tts", "v", ""), ("r.wav", "fake", "tts", "v", "lost.wav"),
                  ("a.wav", "real", "x", "", ""), ("t.wav", "real", "tagarela", "", "a.wav"))
    disk = files(spark, ["real/a.wav", "fake/v/a.wav", "real/extra.wav"])
    assert rows(reconcile(have, disk)) == [
        ("a.wav", 3, 2, "ok"), ("extra.wav", 0, 1, "missing_row"), ("q.wav", 1, 0, "missing_file"),
        ("r.wav", 1, 0, "missing_file"), ("t.wav", 1, 0, "missing_file")]
    assert rows(real_fake_pairs(have), "entry_seq", "real_seq") == [(1, 0), (3, None)]


def test_transcripts(spark):
    said = spark.createDataFrame([
        ("a.mp3", "first", 0), ("a.mp3", "\t last ", 1), ("a.mp3", " 　", 2),
        ("b.mp3", "😀é", 3), ("c.mp3", "  ", 4), ("x.mp3", "no clip", 5), ("d.mp3.mp3", "twice", 6)],
        "path string, sentence string, line int")
    clips = spark.createDataFrame([(f,) for f in ("a.wav", "b.wav", "c.wav", "d.wav.wav", "a.wav")],
                                  "filename string")
    got = match_transcripts(said, clips, "line")
    assert rows(got) == [("a.wav", "last", 4), ("b.wav", "😀é", 2), ("d.wav.wav", "twice", 5)]
    assert rows(unmatched_clips(clips, got)) == [("c.wav",)]


def test_conversion_end_to_end(spark):
    clips = spark.createDataFrame([(f"/r/c{i}.wav", f"c{i}.wav") for i in range(7)],
                                  "path string, filename string")
    voices = configured_voices(spark, [{"name": n, "voice_id": n} for n in "xy"])
    outputs = spark.createDataFrame([("x", "c0.wav")], "voice string, filename string")
    plan = conversion_plan(clips, voices, outputs, "out", limit=2)
    assert rows(plan, "voice", "source_path", "target_path") == [
        ("x", "/r/c2.wav", "out/x/c2.wav"), ("x", "/r/c4.wav", "out/x/c4.wav"),
        ("y", "/r/c1.wav", "out/y/c1.wav"), ("y", "/r/c3.wav", "out/y/c3.wav")]

    def convert(_, row):
        if row["filename"] == "c3.wav":
            raise RuntimeError("no")
        return {"elapsed_ms": 5}

    outcomes = run_conversion(plan, convert)
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    merged = merged_manifest(ledger(spark), clips, outcomes, "rvc", at)
    assert rows(label_counts(merged)) == [(7, 3)]
    assert rows(merged.where("label = 'fake'"), "filename", "voice_model", "generated_at") == [
        ("c1.wav", "y", "2026-01-01T00:00:00Z"), ("c2.wav", "x", "2026-01-01T00:00:00Z"),
        ("c4.wav", "x", "2026-01-01T00:00:00Z")]


def test_flatten(spark):
    have = ledger(spark, ("a.wav", "real", "", "", ""), ("gone.wav", "real", "", "", ""),
                  ("a.wav", "fake", "rvc", "v w", "a.wav"), ("t.wav", "real", "", "", ""))
    plan = flatten_plan(have, files(spark, ["real/a.wav", "fake/v w/a.wav", "real_tagarela/t.wav"]))
    assert rows(plan.moves, "entry_seq", "path", "filepath") == [
        (0, "real/a.wav", "real/a.wav"), (2, "fake/v w/a.wav", "fake/a_v_w.wav"),
        (3, "real_tagarela/t.wav", "real/t.wav")]
    assert rows(plan.missing, "filename") == [("gone.wav",)]
    assert rows(plan.manifest, "entry_seq", "filename", "filepath", "method") == [
        (0, "a.wav", "real/a.wav", ""), (1, "gone.wav", "", ""), (2, "a_v_w.wav", "fake/a_v_w.wav", "rvc"),
        (3, "t.wav", "real/t.wav", "")]


def test_engine_and_speech_plans(spark):
    clips = spark.createDataFrame([("edge", "x/1_edge_raw.mp3"), ("edge", "x/1_edge.mp3"),
                                   ("polly", "x/1_edge.mp3")], "engine string, path string")
    have = ledger(spark, ("1_edge.wav", "fake", "tts", "polly", ""), ("a_v.wav", "fake", "rvc", "v", ""))
    assert rows(engine_entries(clips, have), "filename", "voice_model") == [("1_edge.wav", "edge")]
    spoken = spark.createDataFrame([("b.wav", "B"), ("a.wav", "A"), ("c.wav", "C")],
                                   "wav_filename string, sentence string")
    assert rows(speech_plan(spoken, "v", have), "filename") == [("b_v.wav",), ("c_v.wav",)]
    assert rows(speech_plan(spoken, "v", have, 1, "tts"), "filename", "sentence") == [("a_v.wav", "A")]


def test_sample_plan(spark):
    df = spark.createDataFrame(
        [("s1", 0, None), ("s1", 1, None), ("s2", 2, "bad"), ("s3", 3, None), ("", 4, None), ("", 5, None)],
        "source_file string, at int, error string")
    stored = spark.createDataFrame([("s3",)], "source_file string")
    fresh = new_samples(df, stored, "at")
    assert rows(fresh, "source_file", "at") == [("", 4), ("", 5), ("s1", 0), ("s2", 2)]
    got = sample_entries(fresh, 12, 10, 10, "T", "at")
    assert rows(got, "index", "filename", "source_file") == [
        (10, "tagarela_000010.wav", "s1"), (11, "tagarela_000011.wav", "")]
    assert set(MANIFEST_FIELDS) <= set(got.columns)


def by_hand(sources, voices, used_sources, bad, limit, floor=60_000):
    used, out = 0, []
    for v in voices:
        if limit - used < floor:
            break
        for f, ms in sorted(sources):
            if (v, f) in used_sources:
                continue
            if used + ms > limit:
                break
            failed = (v, f) in bad
            out.append((v, f, failed))
            used += 0 if failed else ms
    return sorted(out), used


def test_revoicing_against_loop(spark):
    sources = [(f"tagarela_{i:06d}.wav", 9_000 + 977 * (i * 7 % 13)) for i in range(40)]
    voices = ["m", "n", "o"]
    bad = {(v, f) for i, (f, _) in enumerate(sources) for v in voices if (i + len(v)) % 4 == 0}
    have = ledger(spark, ("x", "fake", "elevenlabs_sts", "elevenlabs_sts_m", sources[1][0]))
    errors = spark.createDataFrame([(v, f, "no") for v, f in bad],
                                   "voice string, source_file string, error string")
    table = spark.createDataFrame(sources, "source_file string, duration_ms bigint")
    for limit in (50_000, 300_000, 900_000):
        out, used = run_revoicing(table, voices, have, limit,
                                  lambda df: df.join(errors, ["voice", "source_file"], "left"))
        want = by_hand(sources, voices, {("m", sources[1][0])}, bad, limit)
        got = [] if out is None else rows(
            out.withColumn("failed", F.col("error").isNotNull()), "voice", "source_file", "failed")
        assert (got, used) == want
