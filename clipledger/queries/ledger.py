"""Manifest parsing, merging, counting, locating and renaming on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions.fields import accepted, rejected, typed_or_reject
from clipledger.functions.fields import backfill as fill
from clipledger.operators.locate import carry_over as carried
from clipledger.operators.locate import inventory
from clipledger.operators.locate import locate_files as locate
from clipledger.operators.locate import real_fake_pairs
from clipledger.operators.locate import reconcile as reconcile_names
from clipledger.operators.merge import append_union, incoming_entries
from clipledger.operators.merge import manifest_merge as merge
from clipledger.operators.names import decollide_names as decollide
from clipledger.operators.names import flatten_counts as count_moves
from clipledger.operators.stats import done_counts as count_done
from clipledger.operators.stats import engine_counts as count_engines
from clipledger.operators.stats import label_counts as count_labels
from clipledger.plans.corpus import engine_entries
from clipledger.plans.flatten import flatten_plan, moved_manifest
from clipledger.queries.bindings import (
    DISK_SQL, FAKES_FROM, LEDGER_COLUMNS, LOCATED_SQL, MANIFEST_SQL, STAMP, clips, disk, manifest,
    table, turns,
)
from clipledger.queries.registry import query
from clipledger.session import new_path, stored
from clipledger.sources.store import LedgerStore
from clipledger.sources.tables import manifest_scan, manifest_write
from clipledger.sources.voices import catalogue, parse_voice_spec


def _raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text rows of a manifest file, some with broken numbers."""
    k, kind = F.col("k"), F.col("event_type")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id", F.regexp_extract("props", r"(\d+)", 1).alias("k"))
    return events.select(
        F.format_string("ev_%06d.wav", "event_id").alias("filename"),
        F.when(kind == "view", "fake").otherwise("real").alias("label"),
        kind.alias("method"), F.concat(F.lit("user"), "user_id").alias("voice_model"),
        F.when(kind == "error", "xx").when(kind == "view", "").when(
            kind == "click", F.concat(k, F.lit(".5"))).otherwise(F.concat(F.lit(" -"), k, F.lit("e1 ")))
        .alias("index_rate"),
        F.when(k == "7", F.lit(None).cast("string")).otherwise(k).alias("hop_length"),
        F.when(kind == "signup", F.concat(k, F.lit("x"))).otherwise("0").alias("pitch"),
    )


_RAW_SQL = """
with e as (select *, regexp_extract(props, '(\\d+)', 1) as k from events),
r as (
  select printf('ev_%06d.wav', event_id) as filename,
    case when event_type = 'view' then 'fake' else 'real' end as label, event_type as method,
    'user' || user_id as voice_model,
    case event_type when 'view' then null when 'click' then k::double + 0.5
      else -10 * k::double end as index_rate,
    case when k = '7' then null else k::bigint end as hop_length, 0::bigint as pitch,
    case event_type when 'error' then 'index_rate' when 'signup' then 'pitch' end as reject
  from e)
"""


@query(f"""{_RAW_SQL}
select filename, label, method, voice_model, '' as source_file, '' as generated_at,
  index_rate, null::double as protect, hop_length, pitch
from r where reject is null
""")
def manifest_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(typed_or_reject(_raw_rows(spark, sf_dir))).select(
        "filename", "label", "method", "voice_model", "source_file", "generated_at",
        "index_rate", "protect", "hop_length", "pitch")


@query(f"{_RAW_SQL} select filename, method, reject from r where reject is not null")
def manifest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(typed_or_reject(_raw_rows(spark, sf_dir))).select(
        "filename", "method", "reject")


@query(f"""
with {MANIFEST_SQL}
select row_number() over (order by entry_seq) - 1 as entry_seq, {LEDGER_COLUMNS.split(', ', 1)[1]}
from m
""")
def manifest_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest written as CSV and read back."""
    path = new_path(spark, "manifest-csv")
    manifest_write(manifest(spark, sf_dir), path)
    return manifest_scan(spark, path)[0]


@query(f"""
with {MANIFEST_SQL},
offered as (
  select 0 as part, 0::bigint as ord, filename as origin, filename, 'real' as label, '' as method,
    '' as voice_model, '' as source_file, '' as generated_at
  from (select filename from m where label = 'real'
        union all select printf('page_%06d.wav', page_id) from pages)
  union all
  select 1, turn, '/data/real/' || source_file, source_file, 'fake', 'rvc', voice_model,
    source_file, '{STAMP}' from tn),
fresh as (
  select * from offered o
  where not exists (select 1 from m where m.filename = o.filename
                    and m.voice_model = o.voice_model))
select {LEDGER_COLUMNS} from m
union all
select (select max(entry_seq) from m)
    + row_number() over (order by part, ord, origin, filename, voice_model),
  filename, '', label, method, voice_model, source_file,
  case when method = 'rvc' then 'rmvpe' else '' end, case when method = 'rvc' then 0.75 end,
  case when method = 'rvc' then 0.33 end, case when method = 'rvc' then 0.25 end,
  case when method = 'rvc' then 128 end, case when method = 'rvc' then 0 end, generated_at
from fresh
""")
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns offered as converted clips and all pages as new real clips; reals have no voice at all."""
    m = manifest(spark, sf_dir)
    pages = table(spark, sf_dir, "pages").select(
        F.format_string("page_%06d.wav", "page_id").alias("filename"))
    real = append_union(m.where("label = 'real'").select("filename"), pages)
    converted = turns(spark, sf_dir).select(
        F.col("source_file").alias("filename"), F.col("voice_model").alias("voice"),
        F.concat(F.lit("/data/real/"), "source_file").alias("source_path"),
        F.col("turn").alias("ord"))
    offered = incoming_entries(real, converted, "rvc", STAMP).withColumn(
        "voice_model", F.nullif("voice_model", F.lit("")))
    return merge(m, offered, "part", "ord", "origin")


@query("""
select filename, count(*) as copies from (
  select printf('doc_%06d.wav', doc_id) as filename from documents
  union all select printf('doc_%06d.wav', doc_id) from labels)
group by filename
""")
def root_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two roots read as one; a name in both stays twice."""
    second = table(spark, sf_dir, "labels").select(
        F.format_string("doc_%06d.wav", "doc_id").alias("filename"))
    return append_union(clips(spark, sf_dir), second).groupBy("filename").agg(
        F.count(F.lit(1)).alias("copies"))


@query(f"""
with {MANIFEST_SQL}
select entry_seq,
  case when label = 'real' and method = '' then 'common_voice' else method end as method,
  case when generated_at = '' then 'unknown' else generated_at end as generated_at,
  (label = 'real' and method = '') or generated_at = '' as changed
from m
""")
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(manifest(spark, sf_dir)).select("entry_seq", "method", "generated_at", "changed")


@query(f"""
with {MANIFEST_SQL}
select count(*) filter (label = 'real') as reals, count(*) filter (label = 'fake') as fakes from m
""")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_labels(manifest(spark, sf_dir))


@query(f"with {MANIFEST_SQL} select method, voice_model, count(*) as done from m group by all")
def done_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_done(manifest(spark, sf_dir))


@query(f"""
with {MANIFEST_SQL}
select label, method, voice_model, count(*) as entries from m where filename not like '%1.wav' group by all
union all
select 'next', '', '', max(entry_seq) + 1 from m where filename not like '%1.wav'
union all
select 'samples', '', '', count(*) from m where method = 'tagarela' and filename not like '%1.wav'
""")
def kept_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stored ledger that was appended to, rewritten without some rows and appended to, without reading it."""
    store = LedgerStore(spark, new_path(spark, "ledger"))
    m = manifest(spark, sf_dir)
    store.append(m.where("label = 'real'"), "reals", 0)
    store.append(m.where("method = 'rvc'"))
    store.rewrite(store.read().where("filename not like '%1.wav'"))
    store.append(m.where("label = 'real'"), "reals", 0)   # the same batch again
    store.append(m.where("label = 'fake' and method <> 'rvc' and filename not like '%1.wav'"))
    state = store.state()
    facts = spark.createDataFrame(
        [("next", "", "", state["next_seq"]), ("samples", "", "", state["samples"])],
        "label string, method string, voice_model string, entries bigint")
    return store.counts("label", "method", "voice_model").unionByName(facts)


@query(f"""
with {MANIFEST_SQL},
c as (select * replace (
    case when label = 'real' and method = '' then 'common_voice' when voice_model = 'BRAZIL' then 'late' else method end as method,
    case when generated_at = '' then 'unknown' else generated_at end as generated_at,
    case when voice_model = 'BRAZIL' then 'fake/' || filename when voice_model = 'CANADA' then 'twice/' || filename
      else filepath end as filepath)
  from m)
select entry_seq, filename, filepath, label, method, generated_at, null as entries from c
union all
select null, null, null, label, method, null, count(*) from c group by label, method
""")
def changed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored ledger after a backfill and moves, made as changes of the entries concerned, and its kept counts."""
    store = LedgerStore(spark, new_path(spark, "ledger"))
    store.append(manifest(spark, sf_dir))
    for legacy in ("", "common_voice"):   # as many changes as there are entries make a new version
        store.change(fill(store.read().where(F.col("method") == legacy)).where("changed").drop("changed"))
    path = F.concat(F.lit("fake/"), "filename")
    moved = store.read().where("voice_model in ('BRAZIL', 'CANADA')").withColumn("filepath", path)
    store.change(moved.withColumn("method", F.when(F.col("voice_model") == "BRAZIL", "late").otherwise(F.col("method"))))
    store.change(store.read().where("voice_model = 'CANADA'").withColumn("filepath", F.concat(F.lit("twice/"), "filename")))
    rows = store.read().select("entry_seq", "filename", "filepath", "label", "method", "generated_at",
                               F.lit(None).cast("bigint").alias("entries"))
    return rows.unionByName(store.counts("label", "method"), allowMissingColumns=True)


_ENGINES_SQL = f"""
with {MANIFEST_SQL},
g as (
  select 'real' as kind, lang || '/' as x, lang as voice_model,
    printf('%05d_', doc_id) || lang || '.wav' as filename, doc_id
  from documents)
"""


@query(f"{_ENGINES_SQL} select filename, voice_model, 'tts' as method, '2026-03-10T00:00:00Z' "
       "as generated_at from g where doc_id not in (select doc_id from labels)")
def import_engine_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as engine clips by language; the labelled ones were imported before."""
    path = F.concat(F.lit("golden_audio/"), "lang", F.lit("/clean/"),
                    F.format_string("%05d_", "doc_id"), "lang", F.lit("_raw.mp3"))
    all_clips = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("engine"), path.alias("path"))
    before = all_clips.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    nothing = manifest(spark, sf_dir).where("label = 'fake'")
    had = append_union(nothing.drop("entry_seq"),
                       engine_entries(before, nothing).drop("path"))
    return engine_entries(all_clips, had).select("filename", "voice_model", "method", "generated_at")


@query(f"{_ENGINES_SQL} select voice_model, count(*) as files from g group by voice_model")
def engine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_engines(table(spark, sf_dir, "documents").select(
        F.col("lang").alias("voice_model")))


_ODD_LABELS_SQL = """
x as (select * replace (case when entry_seq % 7 = 3 then 'spoof' when entry_seq % 7 <> 5 then label end as label)
      from m)
"""


@query(f"""
with {MANIFEST_SQL}, {DISK_SQL}, {_ODD_LABELS_SQL},
{LOCATED_SQL.replace("select m.*", "select x.*").replace("from m left", "from x left").replace("m.filename", "x.filename")}
select * from l
""")
def locate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with a third label and without one among the real and fake ones."""
    odd = F.when(F.col("entry_seq") % 7 == 3, "spoof").when(F.col("entry_seq") % 7 != 5, F.col("label"))
    entries = manifest(spark, sf_dir).select("entry_seq", "filename", odd.alias("label"), "voice_model")
    return locate(entries, inventory(disk(spark, sf_dir)))


# Continues a `with` clause that has `l`: `f` holds the final names.  Exact
# here since no name with a voice equals a name of another base.
_NAMES_SQL = """
h as (select *, min(entry_seq) over (partition by filename) as first from l
      where path is not null),
k as (select *, label is distinct from 'real' and entry_seq > first as late,
        regexp_replace(filename, '\\.wav$', '') || '_' || replace(voice_model, ' ', '_') as cand
      from h),
n as (select *, row_number() over (partition by late, cand order by entry_seq) as nth from k),
f as (select entry_seq, label, path, filename, voice_model,
        case when not late then filename when nth = 1 then cand || '.wav'
          else cand || '_' || nth || '.wav' end as name from n)
"""


@query(f"""
with l as (select p_partkey as entry_seq, p_name || '.wav' as filename,
  case when p_type = 'ECONOMY' then 'real' when p_size % 5 = 0 then 'spoof'
    when p_size % 7 <> 0 then 'fake' end as label, p_brand as voice_model,
  '' as path from part), {_NAMES_SQL}
select entry_seq, filename, label, voice_model, name, name <> filename as renamed from f
""")
def decollide_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as clip names: many rows share few names; some have another label or none."""
    return decollide(table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("entry_seq"), F.concat("p_name", F.lit(".wav")).alias("filename"),
        F.when(F.col("p_type") == "ECONOMY", "real").when(F.col("p_size") % 5 == 0, "spoof")
        .when(F.col("p_size") % 7 != 0, "fake").alias("label"),
        F.col("p_brand").alias("voice_model")))


_FLAT_SQL = f"""
with {MANIFEST_SQL}, {DISK_SQL}, {LOCATED_SQL}, {_NAMES_SQL},
mv as (select *, label || '/' || name as filepath from f)
"""


@query(f"""{_FLAT_SQL}
select count(*) as planned, count(*) filter (label = 'real') as reals,
  count(*) filter (label = 'fake') as fakes, count(*) filter (name <> filename) as renamed,
  count(*) filter (path = filepath) as already_there, count(*) filter (path <> filepath) as to_move,
  (select count(*) from l where path is null) as missing,
  count(*) filter (path <> filepath and entry_seq % 10 = 0) as errors,
  count(*) filter (path <> filepath and entry_seq % 10 <> 0) as moved
from mv
""")
def flatten_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = flatten_plan(manifest(spark, sf_dir), inventory(disk(spark, sf_dir)))
    failed = plan.moves.where((F.col("path") != F.col("filepath")) & (F.col("entry_seq") % 10 == 0))
    return count_moves(plan.moves, plan.missing, failed)


@query(f"""{_FLAT_SQL}
select m.entry_seq, coalesce(mv.name, m.filename) as filename, coalesce(mv.filepath, '') as filepath,
  m.label, m.method, m.voice_model, m.source_file, m.generated_at
from m left join mv on mv.entry_seq = m.entry_seq and not (mv.path <> mv.filepath and mv.entry_seq % 10 = 0)
""")
def flatten_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a move in which every tenth file could not be moved."""
    m = manifest(spark, sf_dir)
    plan = flatten_plan(m, inventory(disk(spark, sf_dir)))
    refused = (F.col("path") != F.col("filepath")) & (F.col("entry_seq") % 10 == 0)
    outcomes = plan.moves.select("entry_seq", F.when(refused, "no space left").alias("error"))
    return moved_manifest(m, plan.moves, outcomes).select("entry_seq", "filename", "filepath", "label", "method",
                                "voice_model", "source_file", "generated_at")


@query(f"""
with {MANIFEST_SQL}, {DISK_SQL}
select entry_seq, filename, voice_model from m where filename not in (select name from d)
""")
def carry_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = manifest(spark, sf_dir)
    found = stored(locate(m.select("entry_seq", "filename", "label", "voice_model"),
                          inventory(disk(spark, sf_dir))).where("path is not null"), "found")
    return carried(m, found).select("entry_seq", "filename", "voice_model")


@query(f"""
with {MANIFEST_SQL}, {DISK_SQL},
r as (select filename, count(*) as n from m group by filename),
q as (select name, count(*) as n from d group by name)
select coalesce(filename, name) as filename, coalesce(r.n, 0) as manifest_rows,
  coalesce(q.n, 0) as files,
  case when q.n is null then 'missing_file' when r.n is null then 'missing_row' else 'ok' end
    as status
from r full outer join q on filename = name
""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_names(manifest(spark, sf_dir), inventory(disk(spark, sf_dir)))


@query(f"""
with {MANIFEST_SQL}
select x.entry_seq, x.filename, x.voice_model, x.method, x.source_file, r.entry_seq as real_seq
from m x left join m r on r.label = 'real' and r.filename = x.source_file
where x.label = 'fake' and x.source_file <> '' and x.entry_seq >= {FAKES_FROM}
""")
def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return real_fake_pairs(manifest(spark, sf_dir))


@query("""
with f as (select o_custkey as voice, o_orderkey,
  'models/' || o_custkey || '/' || o_orderkey
    || case o_orderstatus when 'F' then '.pth' when 'O' then '.index' else '.txt' end as path
  from orders)
select voice::varchar as voice, min(path) filter (path like '%.pth') as model_path,
  min(path) filter (path like '%.index') as index_path,
  arg_min(o_orderkey, path) filter (path like '%.pth') as model_bytes
from f group by voice
having count(*) filter (path like '%.pth') > 0 and count(*) filter (path like '%.index') > 0
""")
def voice_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the files of customers' model folders."""
    kind = F.when(F.col("o_orderstatus") == "F", ".pth").when(
        F.col("o_orderstatus") == "O", ".index").otherwise(".txt")
    files = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("models/"), "o_custkey", F.lit("/"), "o_orderkey", kind).alias("path"),
        F.col("o_orderkey").alias("length"))
    return catalogue(files)


@query("""
select s_suppkey, 0::bigint as ord, s_name as voice, 'id:' || s_suppkey as voice_id from supplier
union all
select s_suppkey, 1, 'n' || s_nationkey, 'x' from supplier
""")
def voice_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's row as a spec of two voices, one id with a colon in it."""
    spec = F.concat("s_name", F.lit(" :id:"), "s_suppkey", F.lit(", n"), "s_nationkey",
                    F.lit(": x "))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", spec.alias("spec"))
    return parse_voice_spec(rows, F.col("spec")).drop("spec")
