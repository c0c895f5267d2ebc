"""Assignment, pending work, limits and budgets on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.operators.assign import assign_cross as cross
from clipledger.operators.assign import assign_stratified
from clipledger.operators.budget import budget_estimate as estimate
from clipledger.operators.budget import budget_plan as plan_budget
from clipledger.operators.names import next_index, sequence_assign
from clipledger.operators.ordering import global_position
from clipledger.operators.pending import (
    cross_plan_counts, first_n_successes as first_successes, limit_per_voice as per_voice,
    pending_by_key as by_key, pending_by_source as by_source, pending_members as members_left,
    pending_speech, plan_counts, set_difference, skipped_members,
)
from clipledger.operators.stats import ingest_counts as count_ingest
from clipledger.plans.corpus import speech_plan
from clipledger.queries.bindings import (
    MANIFEST_SQL, OUTPUTS_SQL, clips, doc_name, manifest, outputs, table, turns, voices,
)
from clipledger.queries.registry import query

_ASSIGNED_SQL = """
c as (select printf('doc_%06d.wav', doc_id) as filename from documents),
p as (select filename, row_number() over (order by filename) - 1 as pos from c),
a as (select r_name as voice, filename from p join region
      on pos % (select count(*) from region) = r_regionkey)
"""
_SOME_ASSIGNED_SQL = """
c as (select printf('doc_%06d.wav', doc_id) as filename from documents),
p as (select filename, row_number() over (order by filename) - 1 as pos from c),
v as (select r_name as voice, row_number() over (order by r_regionkey) - 1 as turn from region
      where r_regionkey % 2 = 1 or r_regionkey = 4),
a as (select voice, filename from p join v on pos % (select count(*) from v) = turn)
"""


@query(f"""
with {_ASSIGNED_SQL}, o as ({OUTPUTS_SQL}),
f as (select a.voice, a.filename,
        exists (select 1 from o where o.voice = a.voice and o.filename = a.filename) as done
      from a),
n as (select *, row_number() over (partition by voice, done order by filename) as nth from f)
select voice, count(*) as assigned, count(*) filter (done) as skipped,
  count(*) filter (not done) as pending,
  count(*) filter (not done and nth <= 10) as admitted
from n group by voice
""")
def plan_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips dealt to voices in turn, finished ones left out, ten per voice let in."""
    work = assign_stratified(clips(spark, sf_dir), voices(spark, sf_dir), "filename")
    return plan_counts(work, outputs(spark, sf_dir), limit=10)


@query(f"""
with o as ({OUTPUTS_SQL})
select r_name as voice, count(*) as assigned, count(o.filename) as skipped,
  count(*) - count(o.filename) as pending
from documents cross join region
left join (select distinct * from o) as o
  on o.voice = r_name and o.filename = printf('doc_%06d.wav', doc_id)
group by r_name
""")
def plan_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_plan_counts(clips(spark, sf_dir), voices(spark, sf_dir), outputs(spark, sf_dir))


@query("""
select printf('doc_%06d.wav', doc_id) as filename, r_name as voice
from documents cross join region
""")
def assign_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross(clips(spark, sf_dir), voices(spark, sf_dir)).select("filename", "voice")


@query(f"with {_SOME_ASSIGNED_SQL} select voice, filename from a")
def assign_stratified_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips dealt to some of the voices, whose turns have gaps."""
    some = voices(spark, sf_dir).where("ord % 2 = 1 or ord = 4")
    work = assign_stratified(clips(spark, sf_dir), some, "filename")
    return work.select("voice", "filename")


@query("""
select o_orderkey, o_custkey,
  row_number() over (order by o_custkey, o_orderkey) - 1 as pos
from orders
""")
def assign_positions_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return global_position(keys, "o_custkey", "o_orderkey")


@query("""
select o_orderkey, o_custkey from orders
where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')
""")
def pending_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"))
    return set_difference(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, "o_orderkey")


def _limit_sql(limit: int) -> str:
    return f"""
    select voice, o_orderkey from (
      select o_orderpriority as voice, o_orderkey,
        row_number() over (partition by o_orderpriority order by o_orderkey) as nth
      from orders)
    where nth <= {limit}
    """


def _by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("voice"), "o_orderkey")


@query(_limit_sql(25))
def limit_per_voice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_voice(_by_priority(spark, sf_dir), 25, "o_orderkey")


@query(_limit_sql(2500))
def limit_per_voice_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_voice(_by_priority(spark, sf_dir), 2500, "o_orderkey")


def _pending_sql(where: str) -> str:
    return f"""
    with {MANIFEST_SQL}
    select filename, voice_model, source_file from tn
    where not exists (select 1 from m where m.voice_model = tn.voice_model and {where})
    """


_WORK = ["filename", "voice_model", "source_file"]


@query(_pending_sql("m.filename = tn.filename"))
def pending_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_key(turns(spark, sf_dir).select(_WORK), manifest(spark, sf_dir)).select(_WORK)


@query(_pending_sql("m.filename = tn.filename and m.method = 'tts'"))
def pending_by_key_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_speech(turns(spark, sf_dir).select(_WORK), manifest(spark, sf_dir)).select(_WORK)


@query(_pending_sql("m.source_file = tn.source_file"))
def pending_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_source(turns(spark, sf_dir).select(_WORK), manifest(spark, sf_dir)).select(_WORK)


@query(f"""
with {MANIFEST_SQL},
v as (select n_name as voice from nation where n_nationkey = 1),
s as (select printf('doc_%06d.wav', doc_id) as source_file,
        printf('doc_%06d_', doc_id) || voice || '.wav' as filename, voice as voice_model,
        length(text) as chars
      from documents cross join v)
select source_file, filename, voice_model, chars from s
where not exists (select 1 from m where m.filename = s.filename
                  and m.voice_model = s.voice_model and m.method = 'tts')
order by source_file limit 250
""")
def head_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 250 sentences for one voice."""
    voice = table(spark, sf_dir, "nation").where("n_nationkey = 1").first()["n_name"]
    sentences = table(spark, sf_dir, "documents").select(
        doc_name("doc_id").alias("wav_filename"), F.col("text").alias("sentence"))
    plan = speech_plan(sentences, voice, manifest(spark, sf_dir), 250, "tts")
    return plan.select("source_file", "filename", "voice_model",
                       F.length("sentence").cast("bigint").alias("chars"))


_MEMBERS_SQL = """
u as (select page_id, url, regexp_replace(url, '[?#].*$', '') as plain from pages),
mb as (select regexp_extract(url, '//([^/]*)/', 1) as archive, page_id as seq, plain not like '%/' as is_file,
         regexp_replace(plain, '/(fr|en)/', '/clips/') || '.mp3' as member from u),
w as (select *, regexp_replace(split_part(member, '/', -1), '\\.mp3$', '.wav') as wav_name
      from mb where is_file and member like '%/clips/%'),
k as (select * from (select *, row_number() over (partition by wav_name order by archive, seq)
      as nth from w) where nth = 1),
e as (select wav_name from w join labels on seq = doc_id)
"""


def _members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pages as archive members, and the names of the labelled ones as extracted."""
    plain = F.regexp_replace("url", "[?#].*$", "")
    members = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "//([^/]*)/", 1).alias("archive"),
        F.col("page_id").alias("seq"), (~plain.endswith("/")).alias("is_file"),
        F.concat(F.regexp_replace(plain, "/(fr|en)/", "/clips/"), F.lit(".mp3")).alias("member"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("seq"))
    existing = members.join(labels, "seq", "left_semi").where(
        F.col("is_file") & F.col("member").contains("/clips/")).select(
        F.regexp_replace(F.substring_index("member", "/", -1), r"\.mp3$", ".wav")
        .alias("filename"))
    return members, existing


@query(f"""
with {_MEMBERS_SQL}
select archive, member, seq, wav_name from k where wav_name not in (select wav_name from e)
""")
def pending_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members_left(*_members(spark, sf_dir)).select("archive", "member", "seq", "wav_name")


@query(f"""
with {_MEMBERS_SQL},
s as (select k.*, wav_name in (select wav_name from e) as skipped, archive like 'm.%' as bad from k)
select count(*) filter (not skipped and not bad) as extracted, count(*) filter (skipped) as skipped,
  count(*) filter (not skipped and bad) as errors,
  count(*) filter (not skipped and not bad) / 8.0::double as per_second
from s
""")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, existing = _members(spark, sf_dir)
    bad = F.when(F.col("archive").startswith("m."), "unreadable")
    fresh = members_left(members, existing).select(F.lit(False).alias("skipped"), bad.alias("error"))
    old = skipped_members(members, existing).select(F.lit(True).alias("skipped"), bad.alias("error"))
    return count_ingest(fresh.unionByName(old), 8.0)


_BUDGET, _FLOOR = 1_500_000, 200


@query(f"""
with recursive
w as (select cast(substr(source, 4) as bigint) as ord, d.doc_id, n_chars as duration_ms,
        coalesce(toxic, 0) = 1 as failed
      from documents d left join labels l on l.doc_id = d.doc_id),
t as (select *, cast(sum(case when failed then 0 else duration_ms end) over (
        partition by ord order by doc_id rows unbounded preceding) as bigint)
        - case when failed then 0 else duration_ms end as before from w),
tot as (select ord, cast(sum(case when failed then 0 else duration_ms end) as bigint) as total
        from w group by ord),
turn as (select ord, total, row_number() over (order by ord) as n from tot),
b(n, used) as (
  select cast(1 as bigint), cast(0 as bigint)
  union all
  select b.n + 1, b.used + case when {_BUDGET} - b.used < {_FLOOR} then 0 else coalesce(
    (select arg_min(t.before, t.doc_id) from t
     where t.ord = turn.ord and b.used + t.before + t.duration_ms > {_BUDGET}),
    turn.total) end
  from b join turn on turn.n = b.n),
s as (select turn.ord, b.used, (select min(t.doc_id) from t where t.ord = turn.ord
        and b.used + t.before + t.duration_ms > {_BUDGET}) as stop
      from b join turn on turn.n = b.n where {_BUDGET} - b.used >= {_FLOOR})
select t.ord, t.doc_id, t.duration_ms, case when failed then 'failed' end as error,
  s.used + t.before as used_before_ms
from t join s on s.ord = t.ord where s.stop is null or t.doc_id < s.stop
""")
def budget_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources take turns on one budget; failed clips cost nothing."""
    bad = table(spark, sf_dir, "labels").where("toxic = 1").select(
        "doc_id", F.lit("failed").alias("error"))
    work = table(spark, sf_dir, "documents").select(
        F.substring("source", 4, 9).cast("bigint").alias("ord"), "doc_id",
        F.col("n_chars").alias("duration_ms")).join(bad, "doc_id", "left")
    return plan_budget(work, _BUDGET, "doc_id", floor_ms=_FLOOR)


_SUPPLIER_BUDGET = 30_000_000


@query(f"""
with recursive
w as (select l_suppkey as ord, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
        case when l_linenumber % 5 = 2 or l_suppkey % 11 = 5 then null else l_quantity::bigint * 1000 end as duration_ms,
        l_returnflag = 'R' and l_linenumber % 3 = 0 as failed from lineitem),
t as (select *, coalesce(duration_ms, 10700) as ms, row_number() over (
        partition by ord order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as nth
      from w),
u as (select *, cast(sum(case when failed then 0 else ms end) over (
        partition by ord order by nth rows unbounded preceding) as bigint) - case when failed then 0 else ms end as before
      from t),
tot as (select ord, cast(sum(case when failed then 0 else ms end) as bigint) as total from t group by ord),
turn as (select ord, total, row_number() over (order by ord) as n from tot),
b(n, used) as (
  select cast(1 as bigint), cast(0 as bigint)
  union all
  select b.n + 1, b.used + case when {_SUPPLIER_BUDGET} - b.used < {_FLOOR} then 0 else coalesce(
    (select arg_min(u.before, u.nth) from u
     where u.ord = turn.ord and b.used + u.before + u.ms > {_SUPPLIER_BUDGET}), turn.total) end
  from b join turn on turn.n = b.n),
s as (select turn.ord, b.used, (select min(u.nth) from u where u.ord = turn.ord
        and b.used + u.before + u.ms > {_SUPPLIER_BUDGET}) as stop
      from b join turn on turn.n = b.n where {_SUPPLIER_BUDGET} - b.used >= {_FLOOR})
select u.ord, l_orderkey, l_linenumber, duration_ms, s.used + u.before as used_before_ms
from u join s on s.ord = u.ord where s.stop is null or u.nth < s.stop
""")
def budget_many_voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as voices and their lines as clips, some of unknown length; all but a few share what one stop leaves."""
    unknown = (F.col("l_linenumber") % 5 == 2) | (F.col("l_suppkey") % 11 == 5)
    work = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("bigint").alias("ord"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.when(~unknown, F.col("l_quantity").cast("bigint") * 1000).alias("duration_ms"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 3 == 0), "failed").alias("error"))
    return plan_budget(work, _SUPPLIER_BUDGET, "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", floor_ms=_FLOOR).select(
        "ord", "l_orderkey", "l_linenumber", "duration_ms", "used_before_ms")


@query("""
select lang, count(*) as clips, (540.0::double * 60) / (sum(n_chars)::double / count(*) / 1000) as fits
from documents group by lang
""")
def budget_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("clips"), F.sum("n_chars").cast("double").alias("ms"))
    return means.select("lang", "clips", estimate(
        F.lit(540.0), F.col("ms") / F.col("clips") / 1000).alias("fits"))


@query("""
select event_id, ts::varchar as at from (
  select event_id, ts, row_number() over (order by ts, event_id) as nth
  from events where event_type <> 'error')
where nth <= greatest(500 - (select count(*) from labels where toxic = 1), 0)
""")
def first_n_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successes still missing from a target of 500."""
    done = table(spark, sf_dir, "labels").where("toxic = 1").count()
    outcomes = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "error", "error").alias("error"))
    return first_successes(outcomes, 500, done, "ts", "event_id").select(
        "event_id", F.col("ts").cast("string").alias("at"))


@query(f"""
with {MANIFEST_SQL},
s as (select coalesce(max(cast(regexp_extract(filename, '^tagarela_(\\d+)\\.wav$', 1) as bigint)) + 1, 0)
        as start from m where method = 'tagarela')
select event_id, printf('tagarela_%06d.wav', start + row_number() over (order by ts, event_id) - 1)
  as filename
from events cross join s where event_type <> 'error'
""")
def sequence_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = next_index(manifest(spark, sf_dir)).first()["next_index"]
    good = table(spark, sf_dir, "events").where("event_type <> 'error'").select("event_id", "ts")
    return sequence_assign(good, start, "ts", "event_id").select("event_id", "filename")
