"""Collision-free names and sequence names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.functions.fields import is_real
from clipledger.functions.paths import (
    sequence_index, sequence_name, stem, suffix, voice_slug,
)
from clipledger.operators.ordering import global_position, running
from clipledger.operators.skew import lookup_join
from clipledger.schema import METHOD_SAMPLES
from clipledger.session import stored

# Rows with the same voice name and extension ask for the same names in turn.
_LADDER = ["base", "ext"]


def _named(rows: DataFrame) -> DataFrame:
    """Name of a row by its rung: 0 its own, 1 with the voice, k with _k added."""
    numbered = F.concat(
        stem("base"), F.lit("_"), F.col("rung").cast("string"), suffix("filename"))
    return rows.withColumn(
        "name",
        F.when(F.col("rung") == 0, F.col("filename"))
        .when(F.col("rung") == 1, F.col("base"))
        .otherwise(numbered),
    )


def _taken(claims: DataFrame, ladders: DataFrame) -> DataFrame:
    """Rungs (base, ext, b) of the ladders whose name an older row bears.

    claims: name, holder.  ladders: base, ext, oldest; only holders older than
    `oldest` count, so the rung is gone for every row from there on.
    """
    own = stem("name")
    plain = claims.select(F.col("name").alias("base"), suffix("name").alias("ext"),
                          F.lit(1).cast("bigint").alias("b"), "holder")
    numbered = claims.select(
        F.concat(F.regexp_replace(own, r"(?s)_[1-9][0-9]*$", ""), suffix("name")).alias("base"),
        suffix("name").alias("ext"),
        F.regexp_extract(own, r"(?s)^.+_([1-9][0-9]*)$", 1).try_cast("bigint").alias("b"), "holder",
    ).where(F.col("b") >= 2)
    # Without an extension the number may replace a part of the voice; such
    # names are left to the rounds.
    return lookup_join(
        plain.unionByName(numbered), ladders.where(F.col("ext") != ""), _LADDER, "inner",
    ).where(F.col("holder") < F.col("oldest")).select(*_LADDER, "b")


def _count_below(rows: DataFrame, column: str, marks: DataFrame, mark: str) -> DataFrame:
    """Add `below`: how many marks of the row's ladder are less than its `column`."""
    events = rows.withColumns({
        "__x": F.col(column), "__mark": F.lit(0), "__tie": F.col("entry_seq"),
    }).unionByName(
        marks.select(*_LADDER, F.col(mark).alias("__x"), F.lit(1).alias("__mark"),
                     F.col("b").alias("__tie")), allowMissingColumns=True)
    counted = running(events, _LADDER, ["__x", "__mark", "__tie"], below=("sum", F.col("__mark")))
    return counted.where("__mark = 0").select(*rows.columns, "below")


def _nth_free(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Turn `rung`, counted among the free rungs, into the rung itself.

    With taken rungs b1 < b2 < ... the j-th free rung is j plus the number of
    i with b_i - i < j.
    """
    gaps = running(taken, _LADDER, ["b"], i=("count", F.lit(1))).withColumn(
        "gap", F.col("b") - F.col("i"))
    return _count_below(rows, "rung", gaps, "gap").withColumn(
        "rung", F.col("rung") + F.col("below")).drop("below")


def _contested(rows: DataFrame) -> DataFrame:
    """Names that some row that is not real bears although an older row bears them too."""
    return rows.groupBy("name").agg(
        F.min("entry_seq").alias("holder"),
        F.max(F.when(~is_real(), F.col("entry_seq"))).alias("last_fake"),
    ).where(F.col("last_fake") > F.col("holder")).select("name", "holder")


def _climb(rows: DataFrame, contested: DataFrame) -> DataFrame:
    """Move each row that lost its name up to a rung it may get.

    Rows of one ladder keep rising rungs in entry order.  Among the rungs that
    are free for all from the oldest loser on, a row is at least one above the
    row before it: rank + running max(rung - rank).
    """
    lost = ~is_real() & F.coalesce(F.col("entry_seq") > F.col("holder"), F.lit(False))
    bumped = stored(
        lookup_join(rows, contested, ["name"], "left").withColumn("lost", lost).drop("holder")
        .withColumn("rung", F.col("rung") + F.col("lost").cast("bigint")), "bumped")
    ladders = stored(
        bumped.where("lost").groupBy(_LADDER).agg(F.min("entry_seq").alias("oldest")), "ladders")
    claims = bumped.groupBy("name").agg(F.min("entry_seq").alias("holder"))
    taken = stored(_taken(claims, ladders), "taken")
    keep = [c for c in rows.columns if c != "name"]

    on_ladder = lookup_join(bumped.where("rung > 0"), ladders, _LADDER, "left")
    concerned = F.coalesce(F.col("entry_seq") >= F.col("oldest"), F.lit(False))
    rest = bumped.where("rung = 0").select(keep).unionByName(
        on_ladder.where(~concerned).select(keep))
    crowd = on_ladder.where(concerned).select(keep)
    any_taken = not taken.isEmpty()
    if any_taken:
        crowd = _count_below(crowd, "rung", taken, "b").withColumn(
            "rung", F.col("rung") - F.col("below")).drop("below")
    ranked = running(crowd, _LADDER, ["entry_seq"], nth=("count", F.lit(1)))
    spread = running(ranked, _LADDER, ["entry_seq"], lead=("max", F.col("rung") - F.col("nth")))
    moved = spread.withColumn("rung", F.col("nth") + F.col("lead")).select(keep)
    if any_taken:
        moved = _nth_free(moved, taken)
    return _named(rest.unionByName(moved.select(keep)))


def decollide_names(located: DataFrame) -> DataFrame:
    """Add `name`, the final name of each row, and `renamed`.

    In entry order a real keeps its name and so does any other row (fake, of
    another label or none) whose name is free; the others take the first free of stem_voice.ext,
    stem_voice_2.ext, ...  Every name thus goes to the oldest row that asks
    for it, and rows may ask in any order.  The rungs are set by rank at once;
    rounds are needed only while names of different bases meet.
    """
    base = F.concat(stem("filename"), F.lit("_"), voice_slug("voice_model"), suffix("filename"))
    # The sorts carry only what a name depends on; the other columns join at the end.
    narrow = located.select("entry_seq", "filename", "label", "voice_model")
    # Stored, as three reads follow and each would repeat the window.
    rows = stored(
        running(narrow, ["filename"], ["entry_seq"], nth=("count", F.lit(1)))
        .withColumns({"base": base, "ext": suffix("filename")}), "nth")
    late = ~is_real() & (F.col("nth") > 1)
    columns = [*narrow.columns, *_LADDER, "rung"]
    kept = rows.where(~late).withColumn("rung", F.lit(0).cast("bigint")).select(columns)
    ranked = running(rows.where(late).drop("nth"), _LADDER, ["entry_seq"],
                     rung=("count", F.lit(1))).select(columns)
    first = rows.where("nth = 1").select(
        F.col("filename").alias("name"), F.col("entry_seq").alias("holder"))
    taken = _taken(first, ranked.groupBy(_LADDER).agg(F.min("entry_seq").alias("oldest")))
    if not taken.isEmpty():
        # As in a corpus flattened before: a_v.wav, a_v_2.wav, ... are own names.
        ranked = _nth_free(ranked, stored(taken, "taken"))
    state = stored(_named(kept.unionByName(ranked)), "names")
    while True:
        contested = _contested(state)
        if contested.isEmpty():
            break
        state = stored(_climb(state, contested), "names")
    named = state.select(*narrow.columns, "name", (F.col("name") != F.col("filename")).alias("renamed"))
    others = [c for c in located.columns if c not in narrow.columns]
    if others:
        named = named.join(located.select("entry_seq", *others), "entry_seq")
    return named.select(*located.columns, "name", "renamed")


def flat_path(label_col: str = "label", name_col: str = "name"):
    return F.concat(F.when(is_real(), F.lit("real/")).otherwise(F.lit("fake/")), F.col(name_col))


def flatten_counts(plan: DataFrame, missing: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Counts of a move plan (label, path, filepath, renamed), of what has no file, and of moves that failed.

    Every label but real counts as fake, as it goes to the same folder.
    failed: rows of the plan whose move failed, once it was tried; it adds errors and moved.
    """
    there = F.col("path") == F.col("filepath")
    counts = plan.agg(
        F.count(F.lit(1)).alias("planned"),
        F.count_if(is_real()).alias("reals"),
        F.count_if(~is_real()).alias("fakes"),
        F.count_if(F.col("renamed")).alias("renamed"),
        F.count_if(there).alias("already_there"),
        F.count_if(~there).alias("to_move"),
    ).select("*", missing.agg(F.count(F.lit(1)).alias("n")).scalar().alias("missing"))
    if failed is None:
        return counts
    return counts.withColumn("errors", failed.agg(F.count(F.lit(1)).alias("n")).scalar()).withColumn(
        "moved", F.col("to_move") - F.col("errors"))


def next_index(manifest: DataFrame) -> DataFrame:
    """One row: the first free sequence number of the stored samples."""
    return manifest.where(F.col("method") == METHOD_SAMPLES).agg(
        F.coalesce(F.max(sequence_index("filename")) + 1, F.lit(0)).cast("bigint")
        .alias("next_index"))


def sequence_assign(successes: DataFrame, start: int, *order: str) -> DataFrame:
    """Number the successes densely from `start` and name them."""
    return global_position(successes, *order, name="index", start=start).withColumn(
        "filename", sequence_name("index"))
