"""What is left to do: anti-joins against outputs, manifest rows or members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipledger.functions.paths import is_corpus_member, target_path, wav_for_member
from clipledger.operators.ordering import keep_first, meets_in_one_task, running, take_first, tie_break
from clipledger.operators.skew import lookup_join
from clipledger.schema import METHOD_SPEECH


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def set_difference(df: DataFrame, other: DataFrame, *keys: str, unique: bool = False) -> DataFrame:
    """Rows of `df` whose key is not in `other`; repeated rows of `df` stay.

    The key set is reduced before its shuffle; hot keys of `df` do not shuffle.
    `unique` says that no key of `df` repeats, so none can be hot.
    """
    if unique:
        return df.join(distinct_keys(other, *keys), list(keys), "left_anti")
    return lookup_join(df, distinct_keys(other, *keys), list(keys), "left_anti")


def set_intersection(df: DataFrame, other: DataFrame, *keys: str, unique: bool = False) -> DataFrame:
    """Rows of `df` whose key is in `other`."""
    if unique:
        return df.join(distinct_keys(other, *keys), list(keys), "left_semi")
    return lookup_join(df, distinct_keys(other, *keys), list(keys), "left_semi")


def pending_by_output(assigned: DataFrame, outputs: DataFrame, root: str) -> DataFrame:
    """Assigned clips without an output of that name for that voice."""
    return set_difference(assigned, outputs, "voice", "filename").withColumn(
        "target_path", target_path(root, "voice", "filename"))


def plan_counts(assigned: DataFrame, outputs: DataFrame, limit: int | None = None) -> DataFrame:
    """Per voice: assigned, skipped, pending and, under a limit, admitted.

    Both sides are reduced to unique (voice, filename) before they meet.  The
    first `limit` pending rows are admitted, so counting them needs no order.
    """
    key = ["voice", "filename"]
    done = distinct_keys(outputs, *key).withColumn("__done", F.lit(True))
    work = assigned.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    skipped = F.coalesce(F.sum(F.when(F.col("__done"), F.col("__n"))), F.lit(0))
    counts = work.join(done, key, "left").groupBy("voice").agg(
        F.sum("__n").alias("assigned"), skipped.alias("skipped"),
        (F.sum("__n") - skipped).alias("pending"))
    return counts if limit is None else counts.withColumn(
        "admitted", F.least("pending", F.lit(limit).cast("bigint")))


def cross_plan_counts(clips: DataFrame, voices: DataFrame, outputs: DataFrame) -> DataFrame:
    """`plan_counts` for the cross strategy without building the N x M pairs.

    Assigned is the clip count for every voice; skipped counts the outputs
    that belong to a clip.
    """
    names = clips.groupBy("filename").agg(F.count(F.lit(1)).alias("__clips"))
    skipped = distinct_keys(outputs, "voice", "filename").join(names, "filename").groupBy(
        "voice").agg(F.sum("__clips").alias("skipped"))
    total = names.agg(F.coalesce(F.sum("__clips"), F.lit(0)).alias("assigned"))
    return voices.select("voice", total.scalar().alias("assigned")).join(
        skipped, "voice", "left"
    ).select(
        "voice", "assigned", F.coalesce("skipped", F.lit(0)).alias("skipped"),
        (F.col("assigned") - F.coalesce("skipped", F.lit(0))).alias("pending"),
    )


def planned_total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("assigned"), F.lit(0)).alias("planned"))


def limit_per_voice(pending: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """First `limit` rows per voice; None keeps all, 0 keeps none."""
    order = order or ("source_path",)
    if limit is None:
        return pending
    if limit < 0:
        raise ValueError("limit must not be negative")
    pending = pending.withColumn("__tie", tie_break(pending, "voice", *order))
    order = (*order, "__tie")
    if meets_in_one_task(pending, limit):
        nth = F.row_number().over(W.partitionBy("voice").orderBy(*order))
        return pending.withColumn("__nth", nth).where(F.col("__nth") <= limit).drop("__nth", "__tie")
    # Every task sends up to `limit` rows per voice to the voice's one task.
    # A larger limit is counted range by range instead.
    return running(pending, ["voice"], list(order), __nth=("count", F.lit(1))).where(
        F.col("__nth") <= limit).drop("__nth", "__tie")


def pending_by_key(work: DataFrame, manifest: DataFrame, method: str | None = None,
                   unique: bool = False) -> DataFrame:
    """Work whose (filename, voice_model) is not in the manifest, or not under `method`."""
    have = manifest if method is None else manifest.where(F.col("method") == method)
    return set_difference(work, have, "filename", "voice_model", unique=unique)


def pending_speech(work: DataFrame, manifest: DataFrame) -> DataFrame:
    return pending_by_key(work, manifest, METHOD_SPEECH)


def pending_by_source(work: DataFrame, manifest: DataFrame) -> DataFrame:
    """Work whose source was not used yet for that voice."""
    return set_difference(work, manifest, "voice_model", "source_file")


def corpus_members(members: DataFrame) -> DataFrame:
    """Clips among archive members with the name they will get, first per name."""
    clips = members.where(is_corpus_member("member")).withColumn(
        "wav_name", wav_for_member("member"))
    return keep_first(clips, ["wav_name"], "archive", "seq")


def pending_members(members: DataFrame, existing: DataFrame) -> DataFrame:
    """Members to extract; `existing` holds the names already extracted."""
    return set_difference(corpus_members(members), existing.withColumnRenamed(
        "filename", "wav_name"), "wav_name", unique=True)


def skipped_members(members: DataFrame, existing: DataFrame) -> DataFrame:
    return set_intersection(corpus_members(members), existing.withColumnRenamed(
        "filename", "wav_name"), "wav_name", unique=True)


def head_limit(pending: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """First `limit` rows of one voice; None and 0 mean no limit here."""
    return take_first(pending, limit, *order) if limit else pending


def first_n_successes(outcomes: DataFrame, target: int, done: int, *order: str) -> DataFrame:
    """Successful rows in arrival order until `target`, counting the `done` ones."""
    return take_first(outcomes.where(F.col("error").isNull()), max(target - done, 0), *order)
