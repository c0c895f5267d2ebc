"""The operators applied to the whole of their tables, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.llm.byte_pieces import encode_bytes
from clipledger.llm.collocations import collocations
from clipledger.llm.common import documents, words
from clipledger.llm.exact_dedup import exact_groups
from clipledger.llm.katz import score_texts
from clipledger.llm.line_dedup import drop_common_lines
from clipledger.llm.packing import pack_lengths
from clipledger.llm.pieces import encode_decode
from clipledger.llm.quality_classifier import classify
from clipledger.llm.quality_rules import apply_rules
from clipledger.llm.runs import periodic_runs
from clipledger.llm.sharding import shard_documents
from clipledger.llm.simhash import near_duplicates
from clipledger.llm.substring_dedup import remove_repeats


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(documents(spark, sf_dir)).drop("rejected_by")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), shards=40)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), window=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_common_lines(documents(spark, sf_dir), min_docs=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=3, radius=3).select(
        "doc_id", "fingerprint", "component_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(documents(spark, sf_dir), labels, threshold=0.3).select(
        "doc_id", "held_out", "score", "predicted")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_lengths(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    with open(model_path, "rb") as f:   # a tokenizer file of the installation, read on the driver
        model = f.read()
    return encode_decode(documents(spark, sf_dir), model).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir), folds=10)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), least=10, inside_percent=50, top=2_000)


def op12_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None,
                  pattern: str | None = None) -> DataFrame:
    if ranks_path is None or pattern is None:
        import public_tokenizers

        ranks_path = ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    with open(ranks_path, "rb") as f:   # a tokenizer file of the installation, read on the driver
        ranks = f.read()
    return encode_bytes(documents(spark, sf_dir), ranks, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _made_periodic(docs: DataFrame) -> DataFrame:
    """One in ten texts, by a checksum of the id, with its words from word a on replaced by a repeated stretch of p."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", number.alias("h"), F.floor(number / 10).alias("g")).withColumn(
        "ws", F.when(F.col("h") % 10 == 0, words(F.col("text"))))
    n = F.size("ws")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn(
        "p", F.lit(1) + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    source = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.when(
        i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    again = F.array_join(F.transform(source, lambda i: F.get("ws", i.cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_made_periodic(documents(spark, sf_dir)), least=12)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_sharding, op3_substring_dedup, op4_line_dedup, op5_simhash, op6_quality_classifier, op7_packing,
        op8_exact_dedup, op9_sentencepiece, op10_lm_scoring, op11_collocations,
        op12_byte_bpe, op13_periodic_runs)}

_STRIP = r"regexp_replace({0}, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_quality_rules": r"""
        with d as (
            select row_number() over () as r, doc_id, coalesce(text, '') as text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
                   string_split(coalesce(text, ''), chr(10)) as ls,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as full_lines
            from documents),
        win as (
            select r, i, array_to_string(ws[i:i + 4], ' ') as w
            from (select r, ws, unnest(range(1, len(ws) - 3)) as i from d)),
        rep as (select r, i from (select r, i, count(*) over (partition by r, w) as c from win) where c > 1),
        cov as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 5)) as p from rep) group by r),
        m as (
            select d.r, doc_id, text, len(ls) as n_lines, len(ws)::bigint as n_words,
                   length(array_to_string(ws, ''))::bigint as word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
                   (len(full_lines) - len(list_distinct(full_lines)))::bigint as n_dup_lines,
                   coalesce(n, 0)::bigint as n_repeat_words
            from d left join cov on d.r = cov.r),
        b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not (base_failed or 10 * n_symbols > n_words or 10 * n_dup_lines > 3 * greatest(n_lines, 4)
                    or word_chars < 2 * n_words or word_chars > 20 * n_words
                    or 10 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > 3 * word_chars
                    or 10 * length(regexp_replace(text, '[^!?]', '', 'g')) > word_chars
                    or 2 * length(regexp_replace(text, '[^\p{L}]', '', 'g')) < word_chars) as kept
        from b""",
    "op3_substring_dedup": r"""
        with d as (
            select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
            from documents),
        win as (
            select r, id, i, array_to_string(ws[i:i + 19], ' ') as w
            from (select r, id, ws, unnest(range(1, len(ws) - 18)) as i from d)),
        again as (
            select r, i from (
                select r, i, id, first_value(id) over f as first_id, first_value(i) over f as first_i
                from win window f as (partition by w order by id, i))
            where id <> first_id or i <> first_i),
        gone as (select distinct r, p from (select r, unnest(range(i, i + 20)) as p from again)),
        word as (
            select d.r, d.doc_id, p, ws[p] as word from (
                select r, doc_id, ws, unnest(case when len(ws) = 0 then [0] else range(1, len(ws) + 1) end) as p
                from d) d)
        select doc_id, count(*) filter (w.p > 0) as n_words, count(gone.p) as n_removed,
               sha256(coalesce(string_agg(word, ' ' order by w.p) filter (gone.p is null and w.p > 0), '')) as kept_sha256
        from word w left join gone on w.r = gone.r and w.p = gone.p
        group by w.r, doc_id""",
    "op4_line_dedup": rf"""
        with lines as (
            select rowid as r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from (select row_number() over () as rowid, doc_id, text from documents)),
        keyed as (select *, {_LOWER.format(_STRIP.format('line'))} as key from lines),
        common as (select key from keyed where length(key) >= 1 group by key having count(distinct r) >= 10)
        select doc_id, count(*) as n_lines,
               count(*) filter (key in (select key from common)) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos)
                               filter (key not in (select key from common)), '')) as kept_sha256
        from keyed group by r, doc_id""",
    "op8_exact_dedup": f"""
        with n as (select doc_id, {_LOWER.format("coalesce(text, '')")} as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               row_number() over (partition by t order by doc_id desc) = 1 as kept, sha256(t) as text_sha256
        from n""",
    "op11_collocations": rf"""
        with piece as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from (
                select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                    {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece
                from documents)),
        one as (select lang, w, count(*) as f from (select lang, unnest(ws) as w from piece) group by lang, w),
        total as (select lang, sum(f)::bigint as n from one group by lang),
        two as (
            select lang, a, b, count(*) as f from (
                select lang, ws[i] as a, ws[i + 1] as b
                from (select lang, ws, unnest(range(1, len(ws))) as i from piece))
            group by lang, a, b having count(*) >= 10),
        three as (
            select lang, a, b, c, count(*) as f from (
                select lang, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
                from (select lang, ws, unnest(range(1, len(ws) - 1)) as i from piece))
            group by lang, a, b, c having count(*) >= 10),
        longer as (
            select lang, a, b, max(f) as f from (
                select lang, a, b, f from three union all select lang, b, c, f from three)
            group by lang, a, b),
        cuts as (
            select t.lang, a || ' ' || b as phrase, t.f as a, x.f as l, y.f as r, 1 as k
            from two t join one x on t.lang = x.lang and a = x.w join one y on t.lang = y.lang and b = y.w
            where not exists (
                select 1 from longer g where g.lang = t.lang and g.a = t.a and g.b = t.b and 100 * g.f >= 50 * t.f)
            union all
            select t.lang, t.a || ' ' || t.b || ' ' || c, t.f, x.f, y.f, 1
            from three t join one x on t.lang = x.lang and t.a = x.w
                join two y on t.lang = y.lang and t.b = y.a and t.c = y.b
            union all
            select t.lang, t.a || ' ' || t.b || ' ' || c, t.f, x.f, y.f, 2
            from three t join two x on t.lang = x.lang and t.a = x.a and t.b = x.b
                join one y on t.lang = y.lang and t.c = y.w),
        scored as (
            select *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint as score,
                   row_number() over (
                       partition by lang, phrase order by 1000000::hugeint * a * a // (l::hugeint * r), k) as nth
            from cuts),
        ranked as (
            select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
            from scored where nth = 1)
        select r.lang, rank, phrase, a, l, r.r, n, score
        from ranked r join total t on r.lang = t.lang where rank <= 2000""",
}
