"""Incremental jobs: the same rows as a batch, nothing twice."""

import time

import pytest
from compare import rows
from pyspark.sql import functions as F

from clipledger.schema import LEDGER, SAMPLES
from clipledger.sources.commits import FAN, CommitLog
from clipledger.sources.samples import arriving, sample_stream
from clipledger.sources.store import LedgerStore
from clipledger.streaming.convert import convert_batch, convert_stream, read_outcomes
from clipledger.streaming.ingest import ingest_batch, ingest_stream


def noon():
    return F.lit("2026-01-01 12:00:00").cast("timestamp")



def write_samples(spark, path, numbers):
    data = [((bytearray(b"x") if i % 5 else None, f"clips/{i:04d}"), "pt-br" if i % 2 else "en")
            for i in numbers]
    spark.createDataFrame(data, SAMPLES).repartition(2).write.mode("append").parquet(path)


def decode(df):
    return df.withColumn("error", F.when(F.col("bytes").isNull(), "no audio bytes"))


def ingest(spark, tmp_path, store, run, target):
    stream = sample_stream(spark, f"{tmp_path}/in", files_per_trigger=1).select(
        F.coalesce("audio.path", F.lit("")).alias("source_file"), "audio.bytes", "arrival")
    ingest_stream(stream, store, f"{tmp_path}/progress-{run}", target=target, prepare=decode,
                  at=noon()).awaitTermination()
    return store.read()


def test_ingest_resumes_to_its_target(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    write_samples(spark, f"{tmp_path}/in", range(40))
    first = ingest(spark, tmp_path, store, "a", 10)
    assert first.count() == 10
    # New progress reads all files again; only what is missing is added.
    more = ingest(spark, tmp_path, store, "b", 1000)
    good = {f"clips/{i:04d}" for i in range(40) if i % 2 and i % 5}
    assert {r.source_file for r in more.collect()} == good and more.count() == len(good)
    assert ingest(spark, tmp_path, store, "c", 1000).count() == len(good)
    # The same progress reads only new files.
    write_samples(spark, f"{tmp_path}/in", range(40, 60))
    last = ingest(spark, tmp_path, store, "c", 1000)
    n = last.count()
    assert n == len([i for i in range(60) if i % 2 and i % 5])
    assert rows(last, "filename") == [(f"tagarela_{i:06d}.wav",) for i in range(n)]
    assert sorted(r.entry_seq for r in last.collect()) == list(range(n))
    assert rows(last.select("label", "method", "generated_at").distinct()) == [
        ("real", "tagarela", "2026-01-01T12:00:00Z")]


def test_replayed_batch_adds_nothing(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    batch = spark.createDataFrame([("a", b"1"), ("a", b"2"), ("b", None), ("c", b"3")],
                                  "source_file string, bytes binary")
    for _ in range(2):
        ingest_batch(batch, store, None, prepare=decode, at=noon())
        assert rows(store.read(), "source_file", "filename") == [
            ("a", "tagarela_000000.wav"), ("c", "tagarela_000001.wav")]


def test_replayed_stream_batch(spark, tmp_path):
    """A batch whose end Spark did not note is run again, and adds nothing, nameless samples neither."""
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    data = [((b"x", None), "pt-br"), ((b"x", ""), "pt-br"), ((b"x", "a"), "pt-br"), ((None, None), "pt-br")]
    spark.createDataFrame(data, SAMPLES).coalesce(1).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        ingest(spark, tmp_path, store, "a", None)
        assert rows(store.read(), "source_file") == [("",), ("",), ("a",)]
        for name in ("0", ".0.crc"):
            (tmp_path / "progress-a" / "commits" / name).unlink()


def test_append_cut_short_after_one_file(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    table = spark.range(100).select(
        F.col("id").alias("entry_seq"), F.concat(F.lit("f"), "id").alias("filename"), F.lit("real").alias("label"),
        F.lit("tagarela").alias("method"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER.fields
                                             if f.name not in ("entry_seq", "filename", "label", "method")])

    @F.udf("bigint")
    def broken(i):
        if i == 70:
            time.sleep(5)   # the other tasks are done by then
            raise ZeroDivisionError
        return i

    # Tasks put their files in place one by one, and a later one fails.
    spark.conf.set("mapreduce.fileoutputcommitter.algorithm.version", "2")
    try:
        with pytest.raises(Exception, match="ZeroDivisionError"):
            store.append(table.repartitionByRange(4, "entry_seq").withColumn("entry_seq", broken("entry_seq")), "s", 0)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.algorithm.version")
    assert list((tmp_path / "ledger").rglob("*.parquet"))
    assert store.read().count() == 0 and store.version() == 0 and store.state()["next_seq"] == 0
    for _ in range(2):
        store.append(table, "s", 0)
        assert rows(store.read(), "entry_seq") == sorted(((i,) for i in range(100)), key=lambda r: str(r[0]))
    store.append(table.limit(3), "s", 1)
    store.append(table.limit(3), "t", 0)
    store.append(table.limit(3))
    assert store.read().count() == 109 and store.state()["samples"] == 109
    # Which batches are in it is known after a rewrite too.
    store.rewrite(store.read().where("entry_seq < 50"))
    store.append(table, "s", 1)
    assert store.read().count() == 59 and store.version() == 2


def test_many_commits_are_folded(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    for i in range(2 * FAN + 3):
        before = log.newest()
        log.write(before.number + 1, "t", spark.range(i, i + 1).coalesce(1))
        log.mark(before, {"last": i}, "s" if i < FAN + 5 else "other", i)
        log.fold({"t": ("id bigint", ())})
    now = log.newest()
    # 16 of the first stream are one; of the other 14 are not enough.
    assert [c.level for c in now.live] == [1] + [0] * (FAN + 3) and now.state == {"last": 2 * FAN + 2}
    assert sorted(r.id for r in log.read("t", "id bigint").collect()) == list(range(2 * FAN + 3))
    assert log.has("s", FAN + 4) and not log.has("s", FAN + 5) and log.has("other", 2 * FAN + 2)
    log.vacuum("t")
    assert log.newest() == now and log.read("t", "id bigint").count() == 2 * FAN + 3
    assert len(list((tmp_path / "log" / "t").iterdir())) == len(now.live)


@pytest.mark.parametrize("files", [1, 20])
def test_cuts_into_files_agree(spark, tmp_path, monkeypatch, files):
    """Repeated paths, failures and nameless samples over many batches; no batch reads the ledger."""
    data = []
    for i in range(100):
        path = None if i % 10 == 3 else f"p{i * 7 % 60}"
        data.append(((bytearray(b"x") if i % 4 else None, path), "pt-br"))
    for k in range(files):
        part = data[k * len(data) // files:(k + 1) * len(data) // files]
        spark.createDataFrame(part, SAMPLES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
    reads = []
    whole = LedgerStore._rows
    monkeypatch.setattr(LedgerStore, "_rows", lambda *a: reads.append(a) or whole(*a))
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    stream = sample_stream(spark, f"{tmp_path}/in", files_per_trigger=1).select(
        F.col("audio.path").alias("source_file"), "audio.bytes", "arrival")
    query = ingest_stream(stream, store, f"{tmp_path}/progress", None, decode, noon())
    query.awaitTermination()
    assert len(reads) == 1   # what the state is told at the start
    first, want = {}, []
    for i, ((content, path), _) in enumerate(data):
        if path is None or path not in first:
            first[path] = i
            if content:
                want.append(path or "")
    got = store.read().orderBy("entry_seq").select("entry_seq", "filename", "source_file").collect()
    assert [tuple(r) for r in got] == [(i, f"tagarela_{i:06d}.wav", p) for i, p in enumerate(want)]


def test_rows_of_other_writers(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    write_samples(spark, f"{tmp_path}/in", range(1, 4, 2))
    assert ingest(spark, tmp_path, store, "a", None).count() == 2
    batch = spark.createDataFrame([("clips/0007.wav", b"1"), ("clips/0007", b"1")], "source_file string, bytes binary")
    ingest_batch(batch, store, None, prepare=decode, at=noon())
    write_samples(spark, f"{tmp_path}/in", (7, 9))
    assert rows(ingest(spark, tmp_path, store, "a", None), "source_file") == [
        ("clips/0001",), ("clips/0003",), ("clips/0007",), ("clips/0007.wav",), ("clips/0009",)]
    # After a rewrite all rows may be others'.
    store.rewrite(store.read().where("source_file <> 'clips/0009'"))
    batch = spark.createDataFrame([("clips/0011", b"1")], "source_file string, bytes binary")
    ingest_batch(batch, store, None, prepare=decode, at=noon())
    write_samples(spark, f"{tmp_path}/in", (11, 13))
    assert rows(ingest(spark, tmp_path, store, "a", None), "source_file")[-2:] == [("clips/0011",), ("clips/0013",)]


def test_counts_are_kept(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    assert rows(store.counts("label")) == [] and store.state() == {"next_seq": 0, "samples": 0, "next_index": 0}
    write_samples(spark, f"{tmp_path}/in", range(20))
    ingest(spark, tmp_path, store, "a", None)
    fake = store.read().where("entry_seq < 3").withColumns({
        "label": F.lit("fake"), "method": F.lit("rvc"), "voice_model": F.lit("v"), "entry_seq": F.col("entry_seq") + 500})
    store.append(fake)
    store.append(fake.withColumn("label", F.lit(None).cast("string")))
    for _ in range(2):
        n = store.read().where("label = 'real'").count()
        assert rows(store.counts("label", "method", "voice_model")) == [
            ("", "rvc", "v", 3), ("fake", "rvc", "v", 3), ("real", "tagarela", "", n)]
        assert rows(store.counts("voice_model")) == [("", n), ("v", 6)] and rows(store.counts()) == [(n + 6,)]
        assert store.state() == {"next_seq": 503, "samples": n, "next_index": n}
        store.rewrite(store.read())


def test_flushes_do_not_change_the_answer(spark, tmp_path):
    clips = [("a.wav", 50_000), ("b.wav", 10_000), ("c.wav", 45_000), ("d.wav", 1_000)]
    kind = "source_file string, duration_ms bigint"
    got = []
    for files in (1, 2, 4):
        root = f"{tmp_path}/{files}"
        for i in range(files):   # one after another, as files arrive in the order of their times
            part = clips[i * 4 // files:(i + 1) * 4 // files]
            spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(f"{root}/in")
            time.sleep(0.05)
        store, log = LedgerStore(spark, f"{root}/ledger"), f"{root}/outcomes"
        stream = arriving(spark, f"{root}/in", kind, files_per_trigger=1)
        convert_stream(stream, store, log, f"{root}/progress", "r", "m", 100_000,
                       lambda df: df.withColumn("error", F.lit(None).cast("string")), noon()).awaitTermination()
        got.append(rows(read_outcomes(spark, log), "source_file", "error"))
    assert got[0] == got[1] == got[2]
    assert set(got[0]) == {("a.wav", None), ("b.wav", None), (None, "budget")}


def test_conversion_in_flushes(spark, tmp_path):
    sources = [(f"s{i:03d}.wav", 30_000 + i) for i in range(20)]
    table = spark.createDataFrame(sources, "source_file string, duration_ms bigint")
    table.repartitionByRange(2, "source_file").sortWithinPartitions("source_file").write.parquet(
        f"{tmp_path}/in")
    store, log = LedgerStore(spark, f"{tmp_path}/ledger"), f"{tmp_path}/outcomes"

    def convert(df):
        return df.withColumn("error", F.when(F.col("source_file") == "s001.wav", "refused"))

    def run(name, voice, limit):
        stream = arriving(spark, f"{tmp_path}/in", table.schema, files_per_trigger=1)
        convert_stream(stream, store, log, f"{tmp_path}/p-{name}-{voice}", name, voice, limit,
                       convert, noon()).awaitTermination()

    run("one", "m", 250_000)
    ok = store.read().where("voice_model = 'elevenlabs_sts_m'")
    assert ok.count() == 8 and ok.where("source_file = 's001.wav'").count() == 0
    # What is left is less than a minute: the next voice gets nothing.
    run("one", "n", 250_000)
    assert store.read().count() == 8
    # A new run has its own budget and goes on with what is not done.
    run("two", "m", 10_000_000)
    done = read_outcomes(spark, log).where("source_file is not null")
    assert done.where("error is null").count() == 19
    assert store.read().count() == 19
    assert rows(store.read().select("entry_seq")) == sorted(
        [(i,) for i in range(19)], key=lambda r: str(r[0]))
    # A refused source is not done, so the next run tries it again.
    refused = rows(done.where("error is not null"), "run", "source_file")
    assert refused[-1] == ("two", "s001.wav") and {f for _, f in refused} == {"s001.wav"}


def test_replayed_conversion_batch(spark, tmp_path):
    store, log = LedgerStore(spark, f"{tmp_path}/ledger"), f"{tmp_path}/outcomes"
    batch = spark.createDataFrame([("a.wav", 50_000), ("b.wav", 50_000), ("c.wav", 50_000)],
                                  "source_file string, duration_ms bigint")
    calls = []

    def convert(df):
        calls.append(df.count())
        return df.withColumn("error", F.lit(None).cast("string"))

    for _ in range(2):
        convert_batch(batch, store, log, "r", "m", 110_000, convert, noon())
    assert rows(store.read(), "source_file", "filename") == [
        ("a.wav", "sts_m_a.wav"), ("b.wav", "sts_m_b.wav")]
    assert sum(calls) == 2


def test_flush_cut_short_before_the_ledger(spark, tmp_path, monkeypatch):
    """Outcomes are committed, then the ledger fails: the next start adds the rows and converts nothing twice."""
    sources = spark.createDataFrame([(f"s{i}.wav", 10_000) for i in range(6)], "source_file string, duration_ms bigint")
    sources.coalesce(1).write.parquet(f"{tmp_path}/in")
    store, log, calls = LedgerStore(spark, f"{tmp_path}/ledger"), f"{tmp_path}/outcomes", []

    def convert(df):
        calls.append(df.count())
        return df.withColumn("error", F.lit(None).cast("string"))

    def run(voice):
        stream = arriving(spark, f"{tmp_path}/in", sources.schema, bytes_per_trigger=1 << 20)
        convert_stream(stream, store, log, f"{tmp_path}/p-{voice}", "r", voice, 10_000_000, convert, noon()).awaitTermination()

    def fail(*_):
        raise RuntimeError("the ledger is away")

    with monkeypatch.context() as m:
        m.setattr(LedgerStore, "append", fail)
        with pytest.raises(Exception, match="the ledger is away"):
            run("m")
    assert read_outcomes(spark, log).count() == 6 and store.read().count() == 0
    run("m")
    assert store.read().count() == 6 and sum(calls) == 6
    run("n")
    assert store.read().count() == 12 and sum(calls) == 12
    assert CommitLog(spark, log).newest().state["runs"]["r"] == {"used": 120_000, "voices": {"m": "begun", "n": "begun"}}
