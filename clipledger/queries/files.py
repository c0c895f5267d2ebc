"""Listings and archives over files that tasks write from the given tables."""

from __future__ import annotations

import io
import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions.paths import basename
from clipledger.plans.corpus import run_extraction
from clipledger.queries.bindings import doc_name, table
from clipledger.queries.registry import query
from clipledger.session import new_path
from clipledger.sources.archives import as_uri, default_file_system, located
from clipledger.sources.folders import (
    clip_listing, default_clip, disk_inventory, engine_listing, listing, output_listing, root_union,
)

_TAR_ROWS = 200   # documents in one archive


def _put(uri: str, content: bytes) -> None:
    filesystem, path = located(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(path, compression=None) as out:
        out.write(content)


def _write_files(files: DataFrame, root: str) -> None:
    """Write each (path, content) below the root, on the executors."""
    base = as_uri(root, default_file_system(files.sparkSession))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _put(f"{base}/{row['path']}", row["content"])
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    files.select("path", "content").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


_FILES_SQL = """
with t as (select documents.*, printf('doc_%06d.wav', doc_id) as f, strlen(text) as bytes from documents),
files as (
  select case when lang = 'fr' then 'real_tagarela/' else 'real/' end || f as path, f, bytes, lang, source from t
  union all
  select 'fake/' || source || '/' || f, f, bytes, lang, source from t where doc_id in (select doc_id from labels)),
engines as (select lang as engine, printf('%06d_', doc_id) || lang || '_raw.mp3' as f from t where lang in ('es', 'fr'))
"""


@query(f"""{_FILES_SQL}
select 'clip' as kind, f as name, bytes as length from files where path like 'real/%'
union all select 'first', min(f), null from files where path like 'real/%'
union all select 'output', source || '/' || f, null from files where path like 'fake/%'
union all select 'root', f, bytes from files where path like 'real%'
union all select 'disk', path, null from files
union all select 'engine', engine || '/' || f, null from engines
union all select 'no engine', 'polly', null
""")
def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as clips, outputs and engine clips, and listed again."""
    root = new_path(spark, "files")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.encode("text", "utf-8").alias("content"), doc_name("doc_id").alias("f"))
    labels = table(spark, sf_dir, "labels").select("doc_id")
    folder = F.when(F.col("lang") == "fr", "real_tagarela/").otherwise("real/")
    _write_files(docs.withColumn("path", F.concat(folder, "f")), root)
    _write_files(docs.join(labels, "doc_id", "left_semi").withColumn(
        "path", F.concat(F.lit("fake/"), "source", F.lit("/"), "f")), root)
    _write_files(docs.where("lang in ('es', 'fr')").withColumn("path", F.concat(
        F.lit("golden_audio/"), "lang", F.lit("/clean/"), F.format_string("%06d_", "doc_id"), "lang", F.lit("_raw.mp3"))), root)

    def row(df: DataFrame, kind: str, name, length=None) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), name.alias("name"),
                         (F.lit(None).cast("bigint") if length is None else F.col(length)).alias("length"))

    real = clip_listing(spark, f"{root}/real")
    engines, missing = engine_listing(spark, root, ["es", "fr", "polly"])
    parts = [
        row(real, "clip", F.col("filename"), "length"),
        row(real.agg(F.first(default_clip(real)).alias("path")), "first", basename("path")),
        row(output_listing(spark, f"{root}/fake"), "output", F.concat_ws("/", "voice", "filename")),
        row(root_union(spark, [f"{root}/real", f"{root}/real_tagarela", f"{root}/none"]), "root", F.col("filename"), "length"),
        row(disk_inventory(spark, root), "disk", F.col("path")),
        row(engines, "engine", F.concat_ws("/", "engine", basename("path"))),
        row(spark.createDataFrame([(m,) for m in missing], "m string"), "no engine", F.col("m")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(f"""
with m as (
  select doc_id, source || '_' || printf('%05d', doc_id // {_TAR_ROWS}) || '.tar.gz' as archive,
    row_number() over (partition by source, doc_id // {_TAR_ROWS} order by doc_id) - 1 as seq,
    printf('doc_%06d.wav', doc_id) as wav_name, strlen(text) < 400 as bad
  from documents),
w as (select *, row_number() over (order by archive, seq) as pos from m
      where doc_id % 9 <> 0 and doc_id not in (select doc_id from labels)),
o as (select *, count(*) filter (not bad) over (order by pos) - case when bad then 0 else 1 end as before from w)
select archive, seq, wav_name, case when bad then 'too short' end as error
from o where before < (select count(*) // 3 from documents)
union all
select archive, seq, wav_name, 'skipped' from m where doc_id % 9 <> 0 and doc_id in (select doc_id from labels)
""")
def extract_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into archives by tasks; clips are extracted until a third is reached, those there before skipped."""
    root = new_path(spark, "archives")
    base = as_uri(root, default_file_system(spark))
    docs = table(spark, sf_dir, "documents")
    archive = F.concat("source", F.lit("_"), F.lpad(F.floor(F.col("doc_id") / _TAR_ROWS).cast("string"), 5, "0"), F.lit(".tar.gz"))
    # At most _TAR_ROWS documents each, so no group is large.
    rows = docs.select(
        archive.alias("archive"), "doc_id", F.encode("text", "utf-8").alias("content"),
        F.concat(F.when(F.col("doc_id") % 9 == 0, "cv/other/").otherwise("cv/clips/"),
                 F.format_string("doc_%06d.mp3", "doc_id")).alias("member"))

    def write(group: pa.Table) -> pa.Table:
        raw = io.BytesIO()
        with tarfile.open(fileobj=raw, mode="w:gz") as tar:
            for row in group.sort_by("doc_id").to_pylist():
                info = tarfile.TarInfo(row["member"])
                info.size = len(row["content"])
                tar.addfile(info, io.BytesIO(row["content"]))
        name = group.column("archive")[0].as_py()
        _put(f"{base}/{name}", raw.getvalue())
        return pa.table({"archive": [name]})

    rows.groupBy("archive").applyInArrow(write, "archive string").agg(F.count(F.lit(1))).collect()
    archives = listing(spark, root, "*.tar.gz")
    existing = table(spark, sf_dir, "labels").select(doc_name("doc_id").alias("filename"))
    short = F.when(F.octet_length("content") < 400, "too short")
    done = run_extraction(spark, archives, existing, docs.count() // 3, lambda df: df.withColumn("error", short))
    return done.outcomes.select(basename("archive").alias("archive"), "seq", "wav_name", "error").unionByName(
        done.skipped.select(basename("archive").alias("archive"), "seq", "wav_name", F.lit("skipped").alias("error")))
