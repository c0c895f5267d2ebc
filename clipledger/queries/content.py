"""Sentences, names, signals, outcomes and streams on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipledger.functions import paths
from clipledger.functions.fields import utc_stamp
from clipledger.functions.signal import (
    centre_clip as clip_centre, downmix, quantise, riff_seconds, seconds_or_default,
)
from clipledger.functions.text import char_count, clean_sentence, retriable
from clipledger.operators.outcomes import convert_rows
from clipledger.operators.outcomes import resolve_attempts as resolve
from clipledger.operators.ordering import keep_first
from clipledger.operators.stats import char_stats as count_chars
from clipledger.operators.stats import run_totals as total_run
from clipledger.operators.stats import voice_summary as summarise
from clipledger.operators.transcripts import match_transcripts, unmatched_clips as unmatched
from clipledger.queries.bindings import STAMP, clips, doc_name, table
from clipledger.queries.registry import query
from clipledger.session import new_path
from clipledger.sources.samples import arriving, sample_stream
from clipledger.sources.store import ErrorTable, LedgerStore
from clipledger.sources.tables import (
    sentences_scan, sentences_write, transcript_scan,
)
from clipledger.streaming.convert import convert_stream, read_outcomes
from clipledger.streaming.ingest import ingest_stream

_BLANKS = r"[\t\n\x0b\f\r\x1c-\x20\x85\xa0]"
_STRIP_SQL = rf"regexp_replace(text, '^{_BLANKS}+|{_BLANKS}+$', '', 'g')"


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.format_string("doc_%06d.mp3", "conv_id").alias("path"),
        F.col("text").alias("sentence"), "turn")


def _labelled_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(doc_name("doc_id").alias("filename"))


@query(f"""
with t as (select conv_id, turn, {_STRIP_SQL} as sentence from conversations
           where conv_id in (select doc_id from labels))
select printf('doc_%06d.wav', conv_id) as wav_filename, arg_max(sentence, turn) as sentence,
  length(arg_max(sentence, turn)) as char_count
from t where sentence <> '' group by conv_id
""")
def transcripts_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_transcripts(
        _transcripts(spark, sf_dir), _labelled_clips(spark, sf_dir), "turn")


@query("""
select printf('doc_%06d.wav', doc_id) as filename from labels
where doc_id not in (select conv_id from conversations where trim(text) <> '')
""")
def unmatched_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = _labelled_clips(spark, sf_dir)
    return unmatched(have, match_transcripts(_transcripts(spark, sf_dir), have, "turn"))


@query("select printf('doc_%06d.mp3', conv_id) as path, text as sentence from conversations")
def transcripts_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts written as tab-separated text and scanned."""
    path = new_path(spark, "transcripts")
    _transcripts(spark, sf_dir).write.options(
        header="true", sep="\t", quote='"', escape='"', ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false").csv(path)
    return transcript_scan(spark, path).select("path", "sentence")


@query("select printf('doc_%06d.wav', doc_id) as wav_filename, text as sentence from documents")
def sentences_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sentences")
    sentences_write(_sentences(spark, sf_dir), path)
    return sentences_scan(spark, path)


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        doc_name("doc_id").alias("wav_filename"), F.col("text").alias("sentence"),
        char_count(F.col("text")).alias("char_count"), "lang")


@query(f"""
with t as (select lang, length({_STRIP_SQL}) as n from documents)
select lang, count(*) as sentences, sum(n)::bigint as total_chars,
  sum(n)::double / count(*) as mean_chars,
  10000 // floor(sum(n)::double / count(*))::bigint as per_quota
from t group by lang
""")
def char_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "documents").select(
        "lang", char_count(clean_sentence(F.col("text"))).alias("char_count"))
    return count_chars(text, "lang")


@query("""
select conv_id, turn, contains(text, '429') or contains(lower(text), 'rate') as retriable
from conversations
""")
def retriable_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", retriable(F.col("text")).alias("retriable"))


@query(r"""
with u as (select page_id, regexp_replace(url, '^https?://', '') as path from pages),
n as (select *, split_part(path, '/', -1) as name from u),
s as (select *, regexp_extract(name, '(?s)^.+(\.[^.]+)$', 1) as suffix from n)
select page_id, name as basename,
  case when contains(path, '/') then split_part(path, '/', -2) else '' end as parent, suffix,
  left(name, length(name) - length(suffix)) as stem,
  replace(name || '.mp3.mp3', '.mp3', '.wav') as transcript_wav,
  case when name = '' then '.mp3' else name end || '.wav' as member_wav,
  replace(name || '_raw', '_raw', '') || '.wav' as engine_wav,
  starts_with(name, '4') as starts_4, ends_with(name, '.html') as is_html
from s
""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", "^https?://", "")
    name = paths.basename(path)
    return table(spark, sf_dir, "pages").select(
        "page_id", name.alias("basename"), paths.parent_name(path).alias("parent"),
        paths.suffix(name).alias("suffix"), paths.stem(name).alias("stem"),
        paths.wav_for_transcript(F.concat(name, F.lit(".mp3.mp3"))).alias("transcript_wav"),
        paths.wav_for_member(F.concat(name, F.lit(".mp3"))).alias("member_wav"),
        paths.wav_for_engine_clip(F.concat(name, F.lit("_raw.mp3"))).alias("engine_wav"),
        name.startswith("4").alias("starts_4"), name.endswith(".html").alias("is_html"))


@query("""
with c as (select c_custkey, c_name || ' x' as voice, printf('clip_%06d.wav', c_custkey) as wav
           from customer)
select c_custkey, 'elevenlabs_' || substr(voice, 1, 8) as api_label,
  'xtts_v2_' || substr(replace(wav, '.wav', '') || '_and_a_long_tail', 1, 20) as cloned_label,
  'elevenlabs_sts_' || voice as revoiced_label, replace(voice, ' ', '_') as slug,
  replace(wav, '.wav', '_' || voice || '.wav') as speech_wav,
  'sts_' || voice || '_' || replace(wav, '.wav', '') || '.wav' as revoiced_wav,
  'data/fake/' || voice || '/' || wav as target, printf('tagarela_%06d.wav', c_custkey * 1000) as seq_wav,
  c_custkey * 1000 as seq_index
from c
""")
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" x")).alias("voice"),
        F.format_string("clip_%06d.wav", "c_custkey").alias("wav"))
    tail = F.concat(F.lit("/in/"), paths.stem("wav"), F.lit("_and_a_long_tail.wav"))
    numbered = paths.sequence_name(F.col("c_custkey") * 1000)
    return rows.select(
        "c_custkey", paths.api_voice_label("voice").alias("api_label"),
        paths.cloned_voice_label(tail).alias("cloned_label"),
        paths.revoiced_label("voice").alias("revoiced_label"),
        paths.voice_slug("voice").alias("slug"),
        paths.speech_name("wav", F.col("voice")).alias("speech_wav"),
        paths.revoiced_name("wav", "voice").alias("revoiced_wav"),
        paths.target_path("data/fake", "voice", "wav").alias("target"),
        numbered.alias("seq_wav"), paths.sequence_index(numbered).alias("seq_index"))


def _joined(levels: Column) -> Column:
    return F.array_join(F.transform(levels, lambda x: x.cast("string")), ",")


@query("""
select vec_id, array_to_string(list_transform(embedding,
  lambda x: cast(trunc(greatest(least(cast(x * 4 * 32767 as float), 32767), -32768)) as bigint)), ',')
  as levels
from embeddings
""")
def pcm_quantise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as signals, four times as loud so that some samples clip."""
    loud = F.transform("embedding", lambda x: (x * 4).cast("float"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", _joined(quantise(loud)).alias("levels"))


@query("""
select vec_id, i - 1 as at, cast(cast((embedding[i]::double + embedding[i + 32]::double) / 2 as float)
  as double) as level
from embeddings, range(1, 33) as t(i)
""")
def pcm_downmix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two halves of a vector as two channels."""
    e = F.col("embedding")
    frames = F.arrays_zip(F.slice(e, 1, 32).alias("l"), F.slice(e, 33, 32).alias("r"))
    mono = downmix(F.transform(frames, lambda f: F.array(f["l"], f["r"])))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(mono).alias("at", "level")).select(
        "vec_id", F.col("at").cast("bigint").alias("at"), F.col("level").cast("double").alias("level"))


@query("""
select vec_id, array_to_string(list_transform(embedding[3:62],
  lambda x: cast(trunc(cast(x * 32767 as float)) as bigint)), ',') as levels
from embeddings
""")
def centre_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle 60 seconds of 64, at one sample a second."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", _joined(quantise(clip_centre(F.col("embedding"), rate=1))).alias("levels"))


@query("""
select doc_id, case when lang = 'de' then 10.7::double else n_chars::double / 16000 end as seconds
from documents
""")
def wav_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 16 kHz mono header of n_chars frames per document; German ones are broken.

    French ones have a list chunk of odd length before the samples.
    """
    def le(value: Column, size: int) -> Column:
        digits = F.lpad(F.hex(value), size * 2, "0")
        return F.concat(*[F.substring(digits, size * 2 - 1 - 2 * i, 2) for i in range(size)])

    size = F.col("n_chars") * 2
    mark = F.when(F.col("lang") == "de", F.hex(F.lit("JUNK"))).otherwise(F.hex(F.lit("data")))
    header = F.concat(
        F.hex(F.lit("RIFF")), le(size + 36, 4), F.hex(F.lit("WAVEfmt ")), F.lit("10000000"),
        F.lit("01000100"), F.lit("803E0000"), F.lit("007D0000"), F.lit("02001000"),
        F.when(F.col("lang") == "fr", F.concat(F.hex(F.lit("LIST")), F.lit("05000000"), F.hex(F.lit("INFOx")), F.lit("00")))
        .otherwise(F.lit("")), mark, le(size, 4))
    return table(spark, sf_dir, "documents").select(
        "doc_id", seconds_or_default(riff_seconds(F.unhex(header))).alias("seconds"))


_ATTEMPTS_SQL = """
with t as (
  select 'u' || user_id || '_' || strftime(ts, '%Y-%m-%d') as filename,
    row_number() over (partition by user_id, strftime(ts, '%Y-%m-%d') order by ts, event_id) as attempt,
    case event_type when 'error' then '429 Too Many Requests' when 'signup' then 'Rate limit reached'
      when 'view' then 'connection reset' end as error
  from events),
a as (select *, error is null or attempt = 3
        or not (contains(error, '429') or contains(lower(error), 'rate')) as final
      from t where attempt <= 3),
g as (select filename, min(attempt) filter (final) as ending, max(attempt) as last from a group by filename)
"""


@query(f"""{_ATTEMPTS_SQL}
select g.filename, case when ending is null then 'open' when error is null then 'ok' else 'failed' end
    as status, coalesce(ending, last) as attempts, error,
  case when ending is null then case last when 1 then 5 else 15 end
    else case ending when 1 then 0 when 2 then 5 else 15 end end::bigint as waited_s
from g left join a on a.filename = g.filename and a.attempt = ending
""")
def resolve_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's first events of a day as the attempts for one file."""
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    log = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), "user_id", F.lit("_"), day).alias("filename"), "ts", "event_id",
        F.when(kind == "error", "429 Too Many Requests").when(kind == "signup", "Rate limit reached")
        .when(kind == "view", "connection reset").alias("error"))
    nth = F.row_number().over(W.partitionBy("filename").orderBy("ts", "event_id"))
    numbered = log.withColumn("attempt", nth).where("attempt <= 3")
    return resolve(numbered, "filename")


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), "user_id").alias("voice"),
        F.format_string("ev_%06d.wav", "event_id").alias("filename"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("failed with "), "props")).alias("error"),
        F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("elapsed_ms"))


_SUMMARY_SQL = r"""
select 'user' || user_id as voice, count(*) filter (event_type <> 'error') as ok,
  count(*) filter (event_type = 'error') as errors,
  sum(regexp_extract(props, '(\d+)', 1)::bigint)::bigint as elapsed_ms
from events group by user_id
"""


@query(_SUMMARY_SQL)
def voice_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(_outcomes(spark, sf_dir))


@query(f"select sum(ok)::bigint as ok, sum(errors)::bigint as errors from ({_SUMMARY_SQL})")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_run(summarise(_outcomes(spark, sf_dir)))


@query(f"""
with e as (select 'user' || user_id as voice, printf('ev_%06d.wav', event_id) as filename,
             'failed with ' || props as error from events where event_type = 'error')
select voice, filename, error, '{STAMP}' as at, voice || '|' || filename || '|' || error as line from e
""")
def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error rows written to their table and read back."""
    errors = ErrorTable(spark, new_path(spark, "errors"))
    for _ in range(2):   # the same batch again
        errors.append(_outcomes(spark, sf_dir), F.lit(STAMP), "run", 0)
    return errors.read()


def _count_words(limits: dict, row: dict) -> dict:
    words = row["text"].split(" ")
    if len(words) < limits["least"]:
        raise ValueError(f"only {len(words)} words")
    return {"words": len(words)}


@query("""
with w as (select doc_id, len(string_split(text, ' ')) as n,
             case when lang <> 'fr' then 9007199254740993 + doc_id end as big from documents)
select doc_id, big, big as seen, array_to_string([doc_id, doc_id + 1], ',') as pair,
  case when n >= 40 then n end as words, case when n < 40 then 'only ' || n || ' words' end as error
from w
""")
def convert_each_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python function per row with set-up per task and errors as values.

    The other columns pass through: integers above 2^53, NULLs and an array.
    """
    big = F.when(F.col("lang") != "fr", F.lit(9007199254740993) + F.col("doc_id"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", big.alias("big"), big.alias("seen"),
        F.array("doc_id", F.col("doc_id") + 1).alias("pair"))
    added = T.StructType([T.StructField("words", T.LongType())])
    return convert_rows(docs, _count_words, added, setup=lambda: {"least": 40}).drop("text").withColumn(
        "pair", F.array_join("pair", ","))


def _document_files(sf_dir: str) -> str:
    """A pattern, since a stream takes a folder or a pattern but not one file."""
    return f"{sf_dir}/documents.parquet*"


def _documents_schema(spark: SparkSession, sf_dir: str) -> T.StructType:
    return table(spark, sf_dir, "documents").schema


@query("""
with s as (select d.doc_id, case when d.doc_id % 10 = 7 then '' else source || '/' || d.doc_id end as source_file
           from documents d left join labels l on l.doc_id = d.doc_id
           where lang = 'en' and coalesce(toxic, 0) = 0),
a as (select 1 as run, * from s union all select 2, * from s where source_file = ''),
n as (select *, row_number() over (order by run, doc_id) - 1 as i from a)
select i as entry_seq, printf('tagarela_%06d.wav', i) as filename, 'real' as label,
  'tagarela' as method, source_file
from n
""")
def accent_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents as a sample stream, run twice; toxic ones fail to decode.

    Every tenth has no path, so nothing tells that the second run brings it again.
    """
    bad = table(spark, sf_dir, "labels").where("toxic = 1").select(
        "doc_id", F.lit("no audio").alias("error"))
    schema = _documents_schema(spark, sf_dir)
    root = new_path(spark, "ingest")
    store = LedgerStore(spark, f"{root}/ledger")
    for run in ("first", "again"):
        stream = sample_stream(spark, _document_files(sf_dir), "en", schema, "lang").select(
            "doc_id", F.when(F.col("doc_id") % 10 != 7, F.concat_ws("/", "source", "doc_id")).alias("source_file"),
            "arrival")
        ingest_stream(
            stream, store, f"{root}/progress-{run}", target=None,
            prepare=lambda df: df.join(bad, "doc_id", "left"),
        ).awaitTermination()
    return store.read().select("entry_seq", "filename", "label", "method", "source_file")


@query("""
with s as (select d.doc_id from documents d left join labels l on l.doc_id = d.doc_id
           where lang = 'en' and coalesce(toxic, 0) = 0),
n as (select *, row_number() over (order by doc_id) - 1 as i from s),
t as (select count(*) // 2 as target from documents where lang = 'en')
select i as entry_seq, printf('tagarela_%06d.wav', i) as filename, 'en/' || doc_id as source_file
from n cross join t where i < target
""")
def ingest_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops half-way: the target binds, and a second run adds nothing."""
    bad = table(spark, sf_dir, "labels").where("toxic = 1").select(
        "doc_id", F.lit("no audio").alias("error"))
    target = table(spark, sf_dir, "documents").where("lang = 'en'").count() // 2
    root = new_path(spark, "ingest")
    store = LedgerStore(spark, f"{root}/ledger")
    for run in ("first", "again"):
        stream = sample_stream(
            spark, _document_files(sf_dir), "en", _documents_schema(spark, sf_dir), "lang").select(
            "doc_id", F.concat_ws("/", "lang", "doc_id").alias("source_file"), "arrival")
        ingest_stream(
            stream, store, f"{root}/progress-{run}", target,
            prepare=lambda df: df.join(bad, "doc_id", "left"),
        ).awaitTermination()
    return store.read().select("entry_seq", "filename", "source_file")


@query("""
select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as at from events
""")
def event_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", utc_stamp(F.col("ts")).alias("at"))


_STREAM_BUDGET = 900_000


@query(f"""
with w as (select printf('doc_%06d.wav', d.doc_id) as source_file, n_chars as ms,
             coalesce(toxic, 0) = 1 as failed
           from documents d left join labels l on l.doc_id = d.doc_id),
t as (select *, sum(case when failed then 0 else ms end) over (order by source_file)
        - case when failed then 0 else ms end as before from w),
s as (select min(source_file) as stop from t where before + ms > {_STREAM_BUDGET})
select source_file, ms as duration_ms, case when failed then 'refused' end as error
from t cross join s where stop is null or source_file < stop
""")
def budget_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sources for one voice until its budget is used."""
    bad = table(spark, sf_dir, "labels").where("toxic = 1").select(
        doc_name("doc_id").alias("source_file"), F.lit("refused").alias("error"))
    root = new_path(spark, "revoicing")
    store = LedgerStore(spark, f"{root}/ledger")
    sources = arriving(spark, _document_files(sf_dir), _documents_schema(spark, sf_dir)).select(
        doc_name("doc_id").alias("source_file"), F.col("n_chars").alias("duration_ms"), "arrival")
    convert_stream(
        sources, store, f"{root}/outcomes", f"{root}/progress", "run", "matilda", _STREAM_BUDGET,
        lambda df: df.join(bad, "source_file", "left"),
    ).awaitTermination()
    return read_outcomes(spark, f"{root}/outcomes").where("source_file is not null").select(
        "source_file", "duration_ms", "error")


@query("""
select source, count(*) as clips, min(printf('doc_%06d.wav', doc_id)) as first_clip
from documents group by source
""")
def first_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default clip and the number of clips of each folder."""
    docs = table(spark, sf_dir, "documents").select(
        "source", doc_name("doc_id").alias("filename"))
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("clips"),
                                      F.min("filename").alias("first_clip"))
