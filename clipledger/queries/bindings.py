"""The given tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipledger.functions.fields import stamp_params
from clipledger.functions.paths import revoiced_name, sequence_name, speech_name
from clipledger.schema import (
    FAKE, LEDGER, METHOD_LEGACY_REAL, METHOD_MODEL, METHOD_REVOICED, METHOD_SAMPLES,
    METHOD_SPEECH, REAL,
)

STAMP = "2026-01-01T00:00:00Z"
FAKES_FROM = 1_000_000_000_000


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the footers once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def doc_name(key: str | Column) -> Column:
    return F.format_string("doc_%06d.wav", key)


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(doc_name("doc_id").alias("filename"))


def voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("ord"), F.col("r_name").alias("voice"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn of a conversation stands for an output of that clip and voice."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return turns.join(voices(spark, sf_dir), F.col("turn") == F.col("ord")).select(
        "voice", doc_name("conv_id").alias("filename"))


OUTPUTS_SQL = """
  select r_name as voice, printf('doc_%06d.wav', conv_id) as filename
  from conversations join region on turn = r_regionkey
"""


def _real_name() -> Column:
    return F.when(F.col("lang") == "fr", sequence_name("doc_id")).otherwise(doc_name("doc_id"))


def reals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    method = F.when(F.col("lang") == "fr", METHOD_SAMPLES).when(
        F.col("lang") == "es", METHOD_LEGACY_REAL).otherwise("")
    rows = docs.select(
        F.col("doc_id").alias("entry_seq"), _real_name().alias("filename"),
        F.lit("").alias("filepath"), F.lit(REAL).alias("label"), method.alias("method"),
        F.lit("").alias("voice_model"),
        F.when(F.col("lang") == "fr", F.concat_ws("/", "source", "doc_id")).otherwise("")
        .alias("source_file"),
        F.when(method == "", "").otherwise(STAMP).alias("generated_at"),
    )
    return stamp_params(rows).select(LEDGER.names)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a clip converted for the voice of its number."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("voice"))
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    rows = said.join(docs, F.col("conv_id") == F.col("doc_id")).join(
        nation, F.col("turn") == F.col("n_nationkey"))
    method = F.when(F.col("role") == "user", METHOD_MODEL).when(
        F.col("role") == "assistant", METHOD_SPEECH).otherwise(METHOD_REVOICED)
    wav = _real_name()
    name = F.when(method == METHOD_MODEL, wav).when(
        method == METHOD_SPEECH, speech_name(wav, F.col("voice"))
    ).otherwise(revoiced_name(wav, "voice"))
    return rows.select(
        "conv_id", "turn", wav.alias("source_file"), F.col("voice").alias("voice_model"),
        method.alias("method"), name.alias("filename"))


def fakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of labelled conversations are the ones already done."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"))
    rows = turns(spark, sf_dir).join(labels, "conv_id", "left_semi").select(
        (F.lit(FAKES_FROM) + F.col("conv_id") * 1000 + F.col("turn")).alias("entry_seq"),
        "filename", F.lit("").alias("filepath"), F.lit(FAKE).alias("label"), "method",
        "voice_model", "source_file", F.lit(STAMP).alias("generated_at"))
    return stamp_params(rows).select(LEDGER.names)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reals(spark, sf_dir).unionByName(fakes(spark, sf_dir))


TURNS_SQL = """
  select conv_id, turn, wav as source_file, n_name as voice_model, method,
    case method when 'rvc' then wav
      when 'tts' then replace(wav, '.wav', '_' || n_name || '.wav')
      else 'sts_' || n_name || '_' || regexp_replace(wav, '\\.wav$', '') || '.wav' end as filename
  from (
    select conv_id, turn, n_name,
      case when lang = 'fr' then printf('tagarela_%06d.wav', doc_id)
        else printf('doc_%06d.wav', doc_id) end as wav,
      case role when 'user' then 'rvc' when 'assistant' then 'tts'
        else 'elevenlabs_sts' end as method
    from conversations join documents on conv_id = doc_id join nation on turn = n_nationkey)
"""

# `m` is the manifest and `tn` the turns, for `with` clauses.
MANIFEST_SQL = f"""
tn as ({TURNS_SQL}),
m as (
  select doc_id as entry_seq,
    case when lang = 'fr' then printf('tagarela_%06d.wav', doc_id)
      else printf('doc_%06d.wav', doc_id) end as filename,
    '' as filepath, 'real' as label,
    case lang when 'fr' then 'tagarela' when 'es' then 'common_voice' else '' end as method,
    '' as voice_model,
    case when lang = 'fr' then source || '/' || doc_id else '' end as source_file,
    '' as f0_method, cast(null as double) as index_rate, cast(null as double) as protect,
    cast(null as double) as volume_envelope, cast(null as bigint) as hop_length,
    cast(null as bigint) as pitch,
    case when lang in ('fr', 'es') then '{STAMP}' else '' end as generated_at
  from documents
  union all
  select {FAKES_FROM} + conv_id * 1000 + turn, filename, '', 'fake', method, voice_model,
    source_file,
    case when method = 'rvc' then 'rmvpe' else '' end,
    case when method = 'rvc' then 0.75 end, case when method = 'rvc' then 0.33 end,
    case when method = 'rvc' then 0.25 end, case when method = 'rvc' then 128 end,
    case when method = 'rvc' then 0 end, '{STAMP}'
  from tn where conv_id in (select doc_id from labels))
"""

LEDGER_COLUMNS = ", ".join(LEDGER.names)


def disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the files that stand for the manifest's clips, some moved or lost."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    place = F.when(F.col("lang") == "fr", "real_tagarela").when(
        F.col("lang") == "es", "old").otherwise("real")
    main = docs.select(F.concat_ws("/", place, _real_name()).alias("path"))
    backup = docs.join(good, "doc_id", "left_semi").select(
        F.concat(F.lit("backup/real/"), _real_name()).alias("path"))
    folder = F.when(F.col("method") == METHOD_MODEL, F.concat(F.lit("fake/"), "voice_model")).when(
        F.col("method") == METHOD_SPEECH, "fake/misc")
    made = fakes(spark, sf_dir).where(folder.isNotNull()).select(
        F.concat_ws("/", folder, "filename").alias("path"))
    strays = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("real/"), F.format_string("page_%06d.wav", "page_id")).alias("path"))
    return main.unionByName(backup).unionByName(made).unionByName(strays)


# Continues a `with` clause that has `m`: `d` holds path, parent and name.
DISK_SQL = """
p as (
  select case lang when 'fr' then 'real_tagarela' when 'es' then 'old' else 'real' end
    || '/' || filename as path
  from m join documents on entry_seq = doc_id where label = 'real'
  union all
  select 'backup/real/' || filename from m join labels on entry_seq = doc_id
  where label = 'real' and quality = 1
  union all
  select case method when 'rvc' then 'fake/' || voice_model else 'fake/misc' end || '/' || filename
  from m where method in ('rvc', 'tts')
  union all
  select 'real/' || printf('page_%06d.wav', page_id) from pages),
d as (select path, split_part(path, '/', -2) as parent, split_part(path, '/', -1) as name from p)
"""

# Continues with `l`: entries with their best path.
LOCATED_SQL = """
l as (
  select entry_seq, filename, label, voice_model, path
  from (
    select m.*, d.path, row_number() over (partition by entry_seq order by
      case when label = 'real'
        then case parent when 'real' then 1 when 'real_tagarela' then 2 else 3 end
        else case when parent = voice_model then 1 when d.path like '%fake%' then 2 else 3 end
      end, d.path) as nth
    from m left join d on d.name = m.filename)
  where nth = 1)
"""
