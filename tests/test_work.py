"""Assignment, pending work, budgets and attempts."""

import random

import numpy as np
import pytest
from compare import rows
from pyspark.sql import functions as F

from clipledger.operators.assign import assign, assign_cross, assign_stratified
from clipledger.operators.budget import Step, Usage, budget_estimate, budget_plan, budget_used
from clipledger.operators.outcomes import (
    convert_rows, convert_until, error_log, failures, resolve_attempts, successes, with_error,
)
from clipledger.operators.pending import (
    cross_plan_counts, first_n_successes, head_limit, limit_per_voice, pending_by_key,
    pending_by_output, pending_by_source, pending_members, pending_speech, plan_counts,
    planned_total, skipped_members,
)
from clipledger.operators.stats import char_stats, ingest_counts, run_totals, voice_summary
from clipledger.plans.conversion import job_limit
from clipledger.sources.voices import configured_voices


def voice_table(spark, *names):
    return configured_voices(spark, [{"name": n, "voice_id": f"id-{n}"} for n in names])


def clip_table(spark, n):
    return spark.createDataFrame([(f"clip{i:03d}.wav",) for i in range(n)], "filename string")


@pytest.mark.parametrize("clips, voices", [(7, 3), (0, 2), (5, 1), (100, 7), (2, 5)])
def test_stratified_is_a_round_robin(spark, clips, voices):
    names = [f"v{i}" for i in range(voices)]
    files = [f"clip{i:03d}.wav" for i in range(clips)]
    got = rows(assign_stratified(clip_table(spark, clips), voice_table(spark, *names), "filename"),
               "voice", "filename")
    assert got == sorted((names[i % voices], f) for i, f in enumerate(files))


def test_cross_and_one_voice(spark):
    clips, voices = clip_table(spark, 4), voice_table(spark, "a", "b")
    assert len(rows(assign_cross(clips, voices))) == 8
    only = rows(assign(clips, voices, "stratified", voice="b"), "voice", "filename")
    assert only == [("b", f"clip{i:03d}.wav") for i in range(4)]


def test_assign_errors(spark):
    with pytest.raises(ValueError):
        assign_cross(clip_table(spark, 1), voice_table(spark, "a").where("ord > 5"))
    with pytest.raises(ValueError):
        assign(clip_table(spark, 1), voice_table(spark, "a"), "diagonal")


@pytest.fixture()
def work(spark):
    done = spark.createDataFrame(
        [("a", "clip000.wav"), ("a", "clip000.wav"), ("a", "other.wav"), ("z", "clip001.wav")],
        "voice string, filename string")
    return clip_table(spark, 5), voice_table(spark, "a", "b"), done


def test_pending_by_output(spark, work):
    clips, voices, done = work
    assigned = assign_cross(clips, voices)
    left = pending_by_output(assigned, done, "data/fake")
    assert ("a", "clip000.wav", "data/fake/a/clip000.wav") not in rows(
        left, "voice", "filename", "target_path")
    assert ("b", "clip000.wav", "data/fake/b/clip000.wav") in rows(
        left, "voice", "filename", "target_path")
    assert left.count() == 9
    # The limit applies after finished work is gone.
    assert rows(limit_per_voice(left, 1, "filename"), "voice", "filename") == [
        ("a", "clip001.wav"), ("b", "clip000.wav")]


def test_plan_counts_agree(spark, work):
    clips, voices, done = work
    want = [("a", 5, 1, 4), ("b", 5, 0, 5)]
    assert rows(plan_counts(assign_cross(clips, voices), done)) == want
    counts = cross_plan_counts(clips, voices, done)
    assert rows(counts) == want
    assert rows(planned_total(counts)) == [(10,)]
    assert "Nested" not in counts._jdf.queryExecution().toString()


def test_pending_against_manifest(spark):
    work = spark.createDataFrame(
        [("a.wav", "v", "s1"), ("b.wav", "v", "s2"), ("a.wav", "w", "s1"), ("a.wav", "w", "s1")],
        "filename string, voice_model string, source_file string")
    have = spark.createDataFrame(
        [("a.wav", "v", "other", "rvc"), ("b.wav", "v", "x", "tts"), ("q.wav", "w", "s1", "tts")],
        "filename string, voice_model string, source_file string, method string")
    key = ("filename", "voice_model")
    assert rows(pending_by_key(work, have), *key) == [("a.wav", "w")] * 2
    assert rows(pending_speech(work, have), *key) == [("a.wav", "v"), ("a.wav", "w"), ("a.wav", "w")]
    assert rows(pending_by_source(work, have), *key) == [("a.wav", "v"), ("b.wav", "v")]


def test_members(spark):
    members = spark.createDataFrame([
        ("t", "cv/clips/a.mp3", 0, True), ("t", "cv/clips/b.b.mp3", 1, True),
        ("t", "cv/clips/a.mp3", 2, True), ("t", "cv/clips/c.mp3", 3, False),
        ("t", "cv/clips/d.MP3", 4, True), ("t", "cv/other/e.mp3", 5, True),
        ("t", "cv\\clips\\f.mp3", 6, True), ("t", "cv/clips/done.mp3", 7, True),
    ], "archive string, member string, seq bigint, is_file boolean")
    existing = spark.createDataFrame([("done.wav",), ("zzz.wav",)], "filename string")
    assert rows(pending_members(members, existing), "wav_name", "seq") == [
        ("a.wav", 0), ("b.b.wav", 1), ("cv\\clips\\f.wav", 6)]
    assert rows(skipped_members(members, existing), "wav_name") == [("done.wav",)]


def test_limits(spark):
    df = clip_table(spark, 6)
    assert head_limit(df, None, "filename").count() == 6
    assert head_limit(df, 0, "filename").count() == 6
    assert rows(head_limit(df, 2, "filename")) == [("clip000.wav",), ("clip001.wav",)]
    assert [job_limit(None, False), job_limit(None, True), job_limit(0, True)] == [5, None, 0]
    outcomes = df.withColumn("error", F.when(F.col("filename") == "clip001.wav", "bad"))
    assert rows(first_n_successes(outcomes, 4, 2, "filename"), "filename") == [
        ("clip000.wav",), ("clip002.wav",)]
    assert first_n_successes(outcomes, 4, 9, "filename").count() == 0


def budget_by_hand(entries, limit, floor):
    """(admitted keys, used): files in order, voice after voice."""
    used, admitted = 0, []
    for turn in sorted({t for t, *_ in entries}):
        if limit - used < floor:
            break
        for t, key, ms, failed in sorted(e for e in entries if e[0] == turn):
            if used + ms > limit:
                break
            admitted.append((t, key, used))
            used += 0 if failed else ms
    return admitted, used


BUDGET = "ord bigint, clip bigint, duration_ms bigint, error string"


@pytest.mark.parametrize("seed", range(6))
def test_budget_against_loop(spark, seed):
    rng = random.Random(seed)
    voices, size = rng.randrange(1, 6), rng.choice([3, 40, 300])
    entries = [(v, c, rng.randrange(1, 20_000), rng.random() < 0.2)
               for v in range(voices) for c in range(rng.randrange(1, size))]
    limit = int(sum(e[2] for e in entries) * rng.random())
    df = spark.createDataFrame([(v, c, ms, "x" if bad else None) for v, c, ms, bad in entries], BUDGET)
    plan = budget_plan(df, limit, "clip", floor_ms=500)
    want, used = budget_by_hand(entries, limit, 500)
    assert sorted(tuple(r) for r in plan.select("ord", "clip", "used_before_ms").collect()) == want
    assert budget_used(plan).first()["used_ms"] == used


@pytest.mark.parametrize("seed", range(4))
def test_budget_of_many_voices(spark, seed):
    """After the first stop hundreds of voices share what is left; some clips have no length, some voices only such."""
    rng = random.Random(seed)
    entries = []
    for v in range(400):
        for c in range(rng.randrange(1, 9)):
            ms = None if v % 50 == 7 or rng.random() < 0.1 else rng.choice([0, 1, 40, rng.randrange(1, 60_000)])
            entries.append((3 * v, c, ms, "x" if rng.random() < 0.3 else None))
    limit, floor = rng.choice([(300_000, 0), (2_000_000, 1), (900_000, 700), (20_000, 5)])
    plan = budget_plan(spark.createDataFrame([*entries, (None, 0, 1, None)], BUDGET).repartition(7), limit, "clip", floor_ms=floor)
    want, used = budget_by_hand([(v, c, 10_700 if ms is None else ms, bad) for v, c, ms, bad in entries], limit, floor)
    assert len({t for t, _, _ in want}) > 2
    assert sorted(tuple(r) for r in plan.select("ord", "clip", "used_before_ms").collect()) == want
    assert budget_used(plan).first()["used_ms"] == used


def test_budget_of_voices_without_lengths(spark):
    plan = budget_plan(spark.createDataFrame([(0, 0, None, None), (0, 1, None, None), (1, 0, None, None)], BUDGET),
                       25_000, "clip", floor_ms=10)
    assert rows(plan, "ord", "clip", "duration_ms", "used_before_ms") == [(0, 0, None, 0), (0, 1, None, 10_700)]


def test_composed_use_of_a_budget():
    """The composed function of random voices at every point."""
    rng = random.Random(5)
    for _ in range(200):
        floor, top = rng.randrange(0, 20), rng.randrange(20, 120)
        usage, voices = Usage(floor, top), []
        for _ in range(rng.randrange(0, 12)):
            need = sorted(rng.sample(range(0, 140), rng.randrange(0, 6)))
            taken = sorted(rng.randrange(0, n + 1) for n in need)
            total = need[-1] if need else 0
            voices.append(Step(np.array(need, np.int64), np.array([*taken, total], np.int64), [None] * (len(need) + 1)))
            voices[-1].taken[:] = np.minimum(voices[-1].taken, np.array([0, *need]))
            usage.then(voices[-1])
        for left in range(0, top + 1):
            now = left
            for step in voices:
                if now >= floor:
                    now -= step.at(now)[0]
            assert usage.of(left) == left - now


@pytest.mark.parametrize("entries, limit, want", [
    ([(0, 0, 60, None), (0, 1, 40, None)], 100, [(0, 0), (0, 1)]),       # exact fit
    ([(0, 0, 60, None), (0, 1, 50, None), (0, 2, 10, None)], 100, [(0, 0)]),  # stops that voice
    ([(0, 0, 60, None), (0, 1, 50, None), (1, 0, 30, None)], 100, [(0, 0), (1, 0)]),
    ([(0, 0, 95, None), (1, 0, 1, None)], 100, [(0, 0)]),                # less than the floor left
    ([(0, 0, 90, "x"), (0, 1, 90, None)], 100, [(0, 0), (0, 1)]),        # a failure costs nothing
    ([], 100, []),
])
def test_budget_cases(spark, entries, limit, want):
    plan = budget_plan(spark.createDataFrame(entries, BUDGET), limit, "clip", floor_ms=10)
    assert rows(plan, "ord", "clip") == want


def test_budget_estimate(spark):
    got = spark.range(1).select(budget_estimate(F.lit(540.0)).alias("a"),
                                budget_estimate(F.lit(540.0), F.lit(0.0)).alias("b")).first()
    assert round(got.a) == 3028 and got.b is None


def attempts_by_hand(errors):
    waited = 0
    for n, e in enumerate(errors[:3], 1):
        if e is None:
            return "ok", n, None, waited
        if n == 3 or not ("429" in e or "rate" in e.lower()):
            return "failed", n, e, waited
        waited += 5 * n
    return "open", len(errors), None, waited


def test_attempts(spark):
    choice = [None, "429 slow down", "RATE limit", "no route", "Resposta vazia da API."]
    rng = random.Random(0)
    logs = {f"f{i}": [rng.choice(choice) for _ in range(rng.randrange(1, 6))] for i in range(120)}
    flat = [(f, n, e) for f, es in logs.items() for n, e in enumerate(es, 1)]
    rng.shuffle(flat)
    df = spark.createDataFrame(flat, "filename string, attempt int, error string")
    got = {r[0]: tuple(r)[1:] for r in resolve_attempts(df, "filename").collect()}
    assert got == {f: attempts_by_hand(es) for f, es in logs.items()}


def test_errors_are_values(spark):
    df = clip_table(spark, 6)

    def convert(context, row):
        if row["filename"] == "clip002.wav":
            raise RuntimeError("broken")
        if row["filename"] == "clip003.wav":
            raise KeyError
        return {"size": context + len(row["filename"])}

    from pyspark.sql import types as T
    out = convert_rows(df, convert, T.StructType([T.StructField("size", T.LongType())]), lambda: 100)
    assert rows(failures(out), "filename", "size", "error") == [
        ("clip002.wav", None, "broken"), ("clip003.wav", None, "KeyError")]
    assert rows(successes(out), "size") == [(111,)] * 4
    log = error_log(out.withColumn("voice", F.lit("v")), F.lit("now"))
    assert rows(log, "line", "at")[0] == ("v|clip002.wav|broken", "now")


def test_passing_columns_stay_as_they_are(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([((1 << 53) + 1, [1, None]), (None, None)], "n bigint, a array<int>")
    seen = convert_rows(df, lambda _, row: {"kind": f"{type(row['n']).__name__}"},
                        T.StructType([T.StructField("kind", T.StringType())]))
    assert rows(seen) == [((1 << 53) + 1, [1, None], "int", None), (None, None, "NoneType", None)]


def test_voices_are_numbered_inside(spark):
    clips, voices = clip_table(spark, 6), spark.createDataFrame([(1, "a"), (2, "b"), (7, "c")], "ord bigint, voice string")
    dealt = assign_stratified(clips, voices, "filename")
    assert rows(dealt.groupBy("voice").count()) == [("a", 2), ("b", 2), ("c", 2)]
    assert assign_cross(clips, voices).count() == 18


def test_limits_break_ties_alike(spark, monkeypatch):
    from clipledger.operators import ordering
    df = spark.createDataFrame([("v", 1, i) for i in range(40)], "voice string, k int, i int")
    first = rows(limit_per_voice(df, 7, "k"))
    head = rows(ordering.take_first(df, 5, "k"))
    monkeypatch.setattr(ordering, "TOP_K_ROWS", 0)
    assert rows(limit_per_voice(df, 7, "k")) == first and rows(ordering.take_first(df, 5, "k")) == head


@pytest.mark.parametrize("wanted, tried", [(0, 0), (3, 5), (6, 11), (50, 12)])
def test_convert_until(spark, wanted, tried):
    """Every other clip fails, so more are tried than wanted, but none too many."""
    calls = []

    def convert(df):
        calls.append(df.count())
        return df.withColumn("error", F.when(F.substring("filename", 7, 1).cast("int") % 2 == 1, "bad"))

    out = convert_until(clip_table(spark, 12), wanted, convert, "filename")
    assert sum(calls) == tried
    if wanted:
        good = successes(out).count()
        assert good == min(wanted, 6)
    else:
        assert out is None


def test_with_error(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    assert rows(with_error(df, F.col("x") > 0, "small"), "x", "error") == [
        (-1, "small"), (1, None), (None, "small")]


def test_summaries(spark):
    out = spark.createDataFrame(
        [("a", None, 5), ("a", "e", 7), ("b", None, 1)], "voice string, error string, elapsed_ms int")
    summary = voice_summary(out)
    assert rows(summary) == [("a", 1, 1, 12), ("b", 1, 0, 1)]
    assert rows(run_totals(summary)) == [(2, 1)]
    seen = spark.createDataFrame([(False, None), (False, "e"), (True, None)],
                                 "skipped boolean, error string")
    assert rows(ingest_counts(seen, 4.0)) == [(1, 1, 1, 0.25)]
    assert rows(ingest_counts(seen, 0.0)) == [(1, 1, 1, None)]


def test_char_stats(spark):
    df = spark.createDataFrame([("a", 30), ("b", 45)], "wav_filename string, char_count bigint")
    assert rows(char_stats(df)) == [(2, 75, 37.5, 10000 // 37)]
    assert rows(char_stats(df.where("char_count > 99"))) == [(0, None, None, None)]
