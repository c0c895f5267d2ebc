"""Files, tables, archives, catalogues and the ledger store in fresh folders."""

import io
import random
import tarfile
import wave

import pytest
from compare import rows
from pyspark.sql import functions as F

from clipledger.plans.corpus import run_extraction
from clipledger.schema import ENGINES, LEDGER, MANIFEST_FIELDS
from clipledger.sources.archives import archive_members, with_payloads
from clipledger.sources.folders import (
    clip_listing, default_clip, disk_inventory, engine_listing, listing, output_listing, root_union,
)
from clipledger.sources.headers import with_file_seconds
from clipledger.sources.samples import samples
from clipledger.sources.store import ErrorTable, LedgerStore
from clipledger.sources.tables import (
    FILE_ORDER, manifest_scan, manifest_write, sentences_scan, sentences_write, transcript_scan,
)
from clipledger.sources.voices import (
    configured_voices, model_voices, spec_voices, with_size_mb,
)


def put(root, *names, data=b"x"):
    for n in names:
        p = root / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)


def test_clip_listing(spark, tmp_path):
    put(tmp_path, "real/b.wav", "real/a.wav", "real/c.mp3", "real/sub/d.wav", "real/tagarela_1.wav")
    clips = clip_listing(spark, f"{tmp_path}/real")
    assert rows(clips, "path", "length", "filename")[0] == (f"{tmp_path}/real/a.wav", 1, "a.wav")
    assert rows(clips, "filename") == [("a.wav",), ("b.wav",), ("tagarela_1.wav",)]
    assert rows(clip_listing(spark, f"{tmp_path}/real", "tagarela_*.wav"), "filename") == [
        ("tagarela_1.wav",)]
    assert spark.range(1).select(default_clip(clips)).first()[0] == f"{tmp_path}/real/a.wav"
    assert "content" not in clips._jdf.queryExecution().executedPlan().toString()
    put(tmp_path, "empty/x.txt")
    for folder in ("empty", "none"):
        with pytest.raises(FileNotFoundError):
            clip_listing(spark, f"{tmp_path}/{folder}")


def test_outputs_and_inventory(spark, tmp_path):
    put(tmp_path, "fake/v one/a.wav", "fake/w/b.txt", "real/a.wav", "real_tagarela/t.wav", "top.wav")
    assert rows(output_listing(spark, f"{tmp_path}/fake")) == [("v one", "a.wav"), ("w", "b.txt")]
    assert output_listing(spark, f"{tmp_path}/none").count() == 0
    assert rows(disk_inventory(spark, str(tmp_path)), "path", "parent", "name") == [
        ("fake/v one/a.wav", "v one", "a.wav"), ("real/a.wav", "real", "a.wav"),
        ("real_tagarela/t.wav", "real_tagarela", "t.wav"),
        ("top.wav", tmp_path.name, "top.wav")]
    both = root_union(spark, [f"{tmp_path}/real", f"{tmp_path}/real_tagarela", f"{tmp_path}/no"])
    assert rows(both, "filename") == [("a.wav",), ("t.wav",)]
    assert root_union(spark, [f"{tmp_path}/no"]).count() == 0


@pytest.mark.parametrize("top", ["golden_audio/", ""])
def test_engine_listing(spark, tmp_path, top):
    put(tmp_path, f"{top}edge/clean/1_edge_raw.mp3", f"{top}edge/clean/2.txt",
        f"{top}polly/clean/1_polly_raw.mp3", f"{top}gtts/raw/1.mp3")
    files, missing = engine_listing(spark, str(tmp_path), ENGINES)
    assert [(e, p.rsplit("/", 1)[1]) for e, p in rows(files)] == [
        ("edge", "1_edge_raw.mp3"), ("polly", "1_polly_raw.mp3")]
    assert missing == ["google", "gtts"]


def test_model_voices(spark, tmp_path):
    put(tmp_path, "zoe/b.pth", "zoe/a.pth", "zoe/z.index", "ann/m.pth", "ann/m.index", "half/m.pth",
        "loose.pth", data=b"12345678")
    voices = model_voices(spark, str(tmp_path))
    assert rows(voices, "ord", "voice", "model_path") == [
        (0, "ann", f"{tmp_path}/ann/m.pth"), (1, "zoe", f"{tmp_path}/zoe/a.pth")]
    assert rows(model_voices(spark, str(tmp_path), ["zoe", "half"]), "ord", "voice") == [(0, "zoe")]
    assert with_size_mb(voices).first()["model_mb"] == 8 / 1024 / 1024
    for folder, only in ((tmp_path, ["half"]), (tmp_path / "no", None)):
        with pytest.raises(FileNotFoundError):
            model_voices(spark, str(folder), only)


def test_voice_lists(spark):
    given = [{"name": "b", "voice_id": "1"}, {"name": "a", "voice_id": "2"}]
    assert rows(configured_voices(spark, given)) == [(0, "b", "1"), (1, "a", "2")]
    assert rows(configured_voices(spark, given, ["a"])) == [(0, "a", "2")]
    with pytest.raises(ValueError):
        configured_voices(spark, given, ["c"])
    assert rows(spec_voices(spark, " x : 1:2 ,y:3")) == [(0, "x", "1:2"), (1, "y", "3")]
    with pytest.raises(Exception, match="expected name:voice_id"):
        spec_voices(spark, "x:1,y").collect()


MANIFEST_CSV = (
    ",".join(MANIFEST_FIELDS) + "\r\n"
    'a.wav,,real,,,,,,,,,,\r\n'
    'b.wav,fake/b.wav,fake,rvc,v,a.wav,rmvpe,0.75,0.33,0.25,128,0,2026-01-01T00:00:00Z\r\n'
    'c.wav,,fake,rvc,v,a.wav,rmvpe,xx,,,,,\r\n'
    'd.wav,,fake,rvc,v,a.wav,rmvpe,,,,1.5,,\r\n'
    '"e ""q"", x\nnew.wav",,fake,tts,"v,w",,,,,,,,\r\n'
    'short.wav,,real\r\n'
    '" pad ",,real,,,,,,,,,,\r\n'
)


def test_manifest_scan(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(MANIFEST_CSV.encode())
    good, bad = manifest_scan(spark, f"{tmp_path}/m.csv")
    assert good.schema.names == LEDGER.names
    got = [tuple(r) for r in good.orderBy("entry_seq").select(
        "entry_seq", "filename", "label", "voice_model", "index_rate", "pitch", "generated_at").collect()]
    assert got == [
        (0, "a.wav", "real", "", None, None, ""),
        (1, "b.wav", "fake", "v", 0.75, 0, "2026-01-01T00:00:00Z"),
        (2, 'e "q", x\nnew.wav', "fake", "v,w", None, None, ""),
        (3, "short.wav", "real", "", None, None, ""),
        (4, " pad ", "real", "", None, None, ""),
    ]
    assert rows(bad, "filename", "reject") == [("c.wav", "index_rate"), ("d.wav", "hop_length")]


def test_manifest_scan_by_header(spark, tmp_path):
    (tmp_path / "old.csv").write_text("label,filename,method\nreal,x.wav,\n")
    good, _ = manifest_scan(spark, f"{tmp_path}/old.csv")
    assert rows(good, "filename", "label", "filepath", "pitch") == [("x.wav", "real", "", None)]
    (tmp_path / "bad.csv").write_text("filename,method\nx.wav,\n")
    good, bad = manifest_scan(spark, f"{tmp_path}/bad.csv")
    assert good.count() == 0 and rows(bad, "reject") == [("label",)]
    good, bad = manifest_scan(spark, f"{tmp_path}/missing.csv")
    assert good.count() == 0 and bad.count() == 0


def test_each_file_is_bound_by_its_own_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("filename,filepath,label,method\nx.wav,real/x.wav,real,\n")
    (tmp_path / "in/b.csv").write_text("filename,label,method,voice_model\ny.wav,fake,tts,V\n")
    (tmp_path / "in/c.csv").write_text("filename,method\nz.wav,tts\n")
    good, bad = manifest_scan(spark, f"{tmp_path}/in")
    assert rows(good, "filename", "filepath", "label", "method", "voice_model") == [
        ("x.wav", "real/x.wav", "real", "", ""), ("y.wav", "", "fake", "tts", "V")]
    assert rows(bad, "filename", "reject") == [("z.wav", "label")]


def test_a_cell_may_be_of_any_length(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("path\tsentence\na.mp3\t" + "x" * 10_000_001 + "\n")
    assert transcript_scan(spark, f"{tmp_path}/t.tsv").select(F.length("sentence")).first()[0] == 10_000_001


def test_manifest_write_keeps_order_and_text(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(MANIFEST_CSV.encode())
    good, _ = manifest_scan(spark, f"{tmp_path}/m.csv")
    manifest_write(good, f"{tmp_path}/out")
    again, bad = manifest_scan(spark, f"{tmp_path}/out")
    assert rows(again) == rows(good) and bad.count() == 0
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("*.csv")))
    assert "b.wav,fake/b.wav,fake,rvc,v,a.wav,rmvpe,0.75,0.33,0.25,128,0,2026-01-01T00:00:00Z" in text
    assert "a.wav,,real,,,,,,,,,,\n" in text


def test_transcripts_and_sentences(spark, tmp_path):
    (tmp_path / "t.tsv").write_text(
        'id\tpath\tsentence\textra\n1\ta.mp3\tolá "x"\te\n2\tb.mp3\t"quoted ""q""\nline"\te\n'
        "3\ta.mp3\tagain\te\n", encoding="utf-8")
    got = transcript_scan(spark, f"{tmp_path}/t.tsv")
    assert [tuple(r) for r in got.orderBy(*FILE_ORDER).select("path", "sentence").collect()] == [
        ("a.mp3", 'olá "x"'), ("b.mp3", 'quoted "q"\nline'), ("a.mp3", "again")]
    table = spark.createDataFrame(
        [("b.wav", ' x, "y"\n ', 5), ("a.wav", "é", 1)], "wav_filename string, sentence string, char_count int")
    sentences_write(table, f"{tmp_path}/s")
    assert rows(sentences_scan(spark, f"{tmp_path}/s")) == [("a.wav", "é"), ("b.wav", ' x, "y"\n ')]


def tar(path, members):
    with tarfile.open(path, "w:gz") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
                t.addfile(info)
            else:
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))


def test_archive_members(spark, tmp_path):
    tar(tmp_path / "a.tar.gz", [("cv/clips", None), ("cv/clips/1.mp3", b"one"), ("cv/x.tsv", b"t")])
    tar(tmp_path / "b.tar.gz", [("cv/clips/2.mp3", b"two")])
    paths = [f"{tmp_path}/a.tar.gz", f"{tmp_path}/b.tar.gz"]
    got = archive_members(spark, paths, ".mp3")
    assert [(r[0][-8:-7], *r[1:]) for r in rows(got)] == [
        ("a", "cv/clips", 0, False, None), ("a", "cv/clips/1.mp3", 1, True, bytearray(b"one")),
        ("a", "cv/x.tsv", 2, True, None), ("b", "cv/clips/2.mp3", 0, True, bytearray(b"two"))]
    assert archive_members(spark, paths, content=False).where("content is not null").count() == 0
    assert got.rdd.getNumPartitions() == 2


def cut_archive(path, members):
    """An archive whose end, far behind the members, cannot be read."""
    tar(path, [*members, ("cv/noise.mp3", random.Random(1).randbytes(1 << 20))])
    path.write_bytes(path.read_bytes()[:-100_000])


def test_archive_scans_are_pruned(spark, tmp_path):
    """Filters on archive and place reach the reader: what lies behind the last place is not even there to be read."""
    for name in "ab":
        tar(tmp_path / f"{name}.tar.gz", [(f"cv/{i}.mp3", b"%d" % i) for i in range(6)])
    cut_archive(tmp_path / "cut.tar.gz", [(f"cv/{i}.mp3", b"%d" % i) for i in range(6)])
    paths = [f"{tmp_path}/{n}.tar.gz" for n in ("a", "b")]
    got = archive_members(spark, paths, ".mp3").where(F.col("archive") == paths[1]).where("seq > 1 and seq <= 3")
    assert rows(got, "seq", "content") == [(2, bytearray(b"2")), (3, bytearray(b"3"))]
    assert got.rdd.getNumPartitions() == 1
    assert archive_members(spark, paths).where("archive in ('x', 'y')").count() == 0
    assert rows(archive_members(spark, paths).where("seq = 2 and member like '%2.mp3'"), "content") == [(bytearray(b"2"),)] * 2
    assert rows(archive_members(spark, paths).where("seq < 1 or seq >= 5"), "seq") == [(0,), (0,), (5,), (5,)]
    with pytest.raises(Exception, match="unexpected end of data|EOF|end-of-stream"):
        archive_members(spark, [f"{tmp_path}/cut.tar.gz"]).where("member = 'none'").count()
    assert archive_members(spark, [f"{tmp_path}/cut.tar.gz"]).where("seq <= 2").count() == 3


def test_wanted_payloads_alone(spark, tmp_path):
    folder = tmp_path / "é 100% #1"
    folder.mkdir()
    cut_archive(folder / "a.tar.gz", [("cv/clips", None), *[(f"cv/{i}.mp3", b"%d" % i) for i in range(1, 9)]])
    tar(folder / "b.tar.gz", [("cv/x.mp3", b"x")])
    wanted = spark.createDataFrame(
        [(f"{folder}/a.tar.gz", s, n) for s, n in ((3, "three"), (0, "folder"), (5, "five"), (3, "again"))]
        + [(f"{folder}/b.tar.gz", s, n) for s, n in ((0, "x"), (7, "none"))], "archive string, seq bigint, name string")
    assert rows(with_payloads(wanted), "name", "content") == sorted([
        ("again", bytearray(b"3")), ("five", bytearray(b"5")), ("folder", None), ("none", None),
        ("three", bytearray(b"3")), ("x", bytearray(b"x"))])
    assert with_payloads(wanted.limit(0)).count() == 0


def test_many_archives_share_tasks(spark, tmp_path):
    """The number of tasks does not grow with the number of archives, given as a list or as a table."""
    for i in range(90):
        tar(tmp_path / f"{i:02d}.tar.gz", [("cv/clips/x.tsv", b"t"), (f"cv/clips/{i}.mp3", b"%d" % i)])
    found = listing(spark, str(tmp_path), "*.tar.gz")
    paths = [r["path"] for r in found.collect()]
    tasks = max(4, 4 * spark.sparkContext.defaultParallelism)
    want = sorted((p, m, k, True, c) for p in paths for i in [int(p[-9:-7])] for m, k, c in (
        ("cv/clips/x.tsv", 0, None), (f"cv/clips/{i}.mp3", 1, bytearray(b"%d" % i))))
    for given in (paths, found):
        got = archive_members(spark, given, ".mp3")
        assert len(paths) == 90 and got.rdd.getNumPartitions() <= tasks
        assert sorted(map(tuple, got.collect())) == want
    assert archive_members(spark, found, content=False).where("content is not null").count() == 0
    assert archive_members(spark, found.limit(0)).count() == 0
    assert archive_members(spark, paths).where(F.col("archive") == paths[70]).count() == 2


def test_payload_tasks_do_not_follow_the_size_of_the_names(spark, tmp_path):
    for i in range(8):
        tar(tmp_path / f"{i}.tar.gz", [("cv/clips/x.mp3", b"%d" % i)])
    wanted = archive_members(spark, listing(spark, str(tmp_path), "*.tar.gz"), content=False).drop("content")
    got = with_payloads(wanted)
    assert rows(got, "content") == [(bytearray(b"%d" % i),) for i in range(8)]
    # Without a number of its own the exchange is joined to one part where tables are small.
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()


def test_extraction_from_a_listing(spark, tmp_path):
    for i in range(30):
        tar(tmp_path / f"{i:02d}.tar.gz", [(f"cv/clips/{i}_{k}.mp3", b"x" * k) for k in range(4)])
    found = listing(spark, str(tmp_path), "*.tar.gz")
    there = spark.createDataFrame([("0_1.wav",), ("29_3.wav",)], "filename string")

    def convert(df):
        return df.withColumn("error", F.when(F.octet_length("content") < 1, "empty"))

    order = sorted(r["path"] for r in found.collect())
    want = [(p, k, "empty" if k == 0 else None) for i, p in enumerate(order) for k in range(4) if (i, k) != (0, 1)][:27]
    assert sum(e is None for _, _, e in want) == 20
    for given in (order, found):
        done = run_extraction(spark, given, there, 20, convert)
        assert rows(done.outcomes, "archive", "seq", "error") == sorted(want, key=lambda r: [(c is None, str(c)) for c in r])
        assert rows(done.skipped, "wav_name") == [("0_1.wav",), ("29_3.wav",)]


def test_deep_listing(spark, tmp_path):
    names = [f"{a}/{b}/x {i}é#%.wav" for a in "abc" for b in ("1", "2 2") for i in range(3)] + ["top.wav", "a/_no/y.wav", "a/.z.wav"]
    put(tmp_path, *names, "b/n.txt", "b/1/deep/er/w.wav")
    want = sorted((f"{tmp_path}/{n}", 1) for n in [*names[:19], "b/1/deep/er/w.wav"])
    assert sorted(map(tuple, listing(spark, str(tmp_path), recursive=True).collect())) == want
    assert rows(listing(spark, str(tmp_path)), "path") == [(f"{tmp_path}/top.wav",)]
    assert rows(listing(spark, [f"{tmp_path}/a/1", f"file://{tmp_path}/b/2 2/"], "x [01]*"), "length") == [(1,)] * 4


def test_error_table(spark, tmp_path):
    table = ErrorTable(spark, f"{tmp_path}/errors")
    assert table.read().count() == 0
    outcomes = spark.createDataFrame([("v", "a.wav", None), ("v", "b.wav", "no")], "voice string, filename string, error string")
    for _ in range(2):
        table.append(outcomes, F.lit("T"), "s", 0)
    table.append(outcomes, F.lit("U"))
    assert rows(table.read()) == [("v", "b.wav", "no", "T", "v|b.wav|no"), ("v", "b.wav", "no", "U", "v|b.wav|no")]


def test_file_seconds(spark, tmp_path):
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(b"\0" * 4 * 12000)
    put(tmp_path, "b.wav")
    (tmp_path / "é #1.wav").write_bytes((tmp_path / "a.wav").read_bytes())
    got = with_file_seconds(clip_listing(spark, str(tmp_path)))
    assert rows(got, "filename", "seconds", "error") == [
        ("a.wav", 1.5, None), ("b.wav", 10.7, None), ("é #1.wav", 1.5, None)]
    lost = with_file_seconds(spark.createDataFrame([(f"{tmp_path}/no.wav",), ("hdfs://nowhere.invalid/a.wav",)], "path string"))
    assert all(r["seconds"] is None and r["error"] for r in lost.collect())


@pytest.mark.parametrize("form", ["{}", "{}/", "file:{}", "file://{}"])
def test_inventory_of_a_root_in_any_form(spark, tmp_path, form):
    put(tmp_path, "data/real/a.wav")
    assert rows(disk_inventory(spark, form.format(f"{tmp_path}/data"))) == [("real/a.wav", "real", "a.wav")]


def test_samples_push_the_filter(spark, tmp_path):
    spark.createDataFrame(
        [((bytearray(b"1"), "p1"), "pt-br"), ((None, "p2"), "en"), ((bytearray(b"3"), "p3"), None)],
        "audio struct<bytes binary, path string>, accent string").write.parquet(f"{tmp_path}/s")
    got = samples(spark, f"{tmp_path}/s").select("audio.path")
    assert rows(got) == [("p1",)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(accent,pt-br)" in plan and "bytes" not in plan.split("ReadSchema")[1]


def test_store_versions(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    assert store.read().count() == 0 and store.version() == 0
    row = dict.fromkeys(LEDGER.names)
    row.update(entry_seq=0, filename="a.wav", label="real", method="", voice_model="")
    one = spark.createDataFrame([tuple(row.values())], LEDGER)
    store.append(one)
    store.append(store.read().withColumn("entry_seq", F.lit(1).cast("bigint")))
    assert rows(store.read(), "entry_seq", "label", "method") == [(0, "real", ""), (1, "real", "")]
    store.rewrite(store.read().withColumn("method", F.lit("common_voice")))
    assert store.version() == 2
    assert rows(store.read(), "method") == [("common_voice",)] * 2
    # A rewrite that did not finish is not seen.
    (tmp_path / "ledger" / "v00000003").mkdir()
    assert store.version() == 2
    plan = store.read().where("method = 'rvc'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "method" in plan.split("PartitionFilters")[1]


def test_changed_entries(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in LEDGER.fields}
    table = spark.range(200).select(*[c.alias(n) for n, c in (blank | {
        "entry_seq": F.col("id"), "filename": F.format_string("f%03d", "id"), "label": F.lit("fake"),
        "method": F.lit("rvc"), "voice_model": F.lit("v")}).items()])
    store.append(table.where("entry_seq < 150"))
    want = {i: (f"f{i:03d}", "rvc") for i in range(150)}
    for k in range(20):   # more than are folded; entries change several times
        ids = [k, k + 1, 100, 5_000 + k]
        store.change(table.limit(1).crossJoin(spark.createDataFrame([(i,) for i in ids], "e bigint")).select(
            F.col("e").alias("entry_seq"), F.concat(F.lit(f"n{k}_"), "e").alias("filename"), F.lit("tagarela").alias("method"),
            *[c for c in LEDGER.names if c not in ("entry_seq", "filename", "method")]))
        want.update({i: (f"n{k}_{i}", "tagarela") for i in ids if i < 200})
        if k in (3, 17):
            store.append(table.where(F.col("entry_seq") == 150 + k))
            want[150 + k] = (f"f{150 + k}", "rvc")
        if k in (0, 3, 10, 19):
            assert {r.entry_seq: (r.filename, r.method) for r in store.read().collect()} == want
            by = {}
            for _, m in want.values():
                by[m] = by.get(m, 0) + 1
            assert {r.method: r.entries for r in store.counts("method").collect()} == by
            assert store.state()["next_seq"] == max(want) + 1 and store.state()["samples"] == by["tagarela"]
    assert store.version() > 1   # so many changes were folded into a new version
