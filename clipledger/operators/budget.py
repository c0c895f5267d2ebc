"""Admitting work in order under one budget shared by voices in turn.

What a voice does to the budget is a step function: of what is left it takes
the part before the first row that does not fit.  Up to the first voice that
stops, sums tell everything.  That voice leaves less than the row it refused,
so of the later ones only the rows within so little matter: each task composes
the functions of its voices into one, the functions of the tasks are applied in
turn, and every task then walks its voices from what it is left with.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.operators.ordering import SLOT, running
from clipledger.operators.skew import lookup_join
from clipledger.schema import BUDGET_FLOOR_MS, DEFAULT_CLIP_SECONDS
from clipledger.session import stored

DEFAULT_CLIP_MS = int(DEFAULT_CLIP_SECONDS * 1000)
_TURN = "ord bigint, __stop bigint, __carried bigint"


def clip_ms(duration: Column | str = "duration_ms") -> Column:
    """The length of a clip; one without counts as a clip of default length."""
    return F.coalesce(duration, F.lit(DEFAULT_CLIP_MS)).cast("bigint")


def budget_plan(work: DataFrame, limit_ms: int, *order: str,
                floor_ms: int = BUDGET_FLOOR_MS) -> DataFrame:
    """Rows that are attempted before the budget stops their voice.

    `work` has ord (turn of the voice), duration_ms (NULL: the default length)
    and, when outcomes are known, error; a failed row is attempted but costs
    nothing; a row without a turn is not attempted.  A voice stops at its first
    row that would exceed what earlier voices left; the next voice goes on
    unless less than `floor_ms` is left.  Adds used_before_ms.  There may be
    any number of voices.
    """
    if "error" not in work.columns:
        work = work.withColumn("error", F.lit(None).cast("string"))
    cost = F.when(F.col("error").isNull(), clip_ms()).otherwise(F.lit(0))
    timed = stored(
        running(work.where("ord is not null"), ["ord"], list(order), keep_slot=True, __after=("sum", cost))
        .withColumns({"__before": F.col("__after") - cost, "__need": F.col("__after") - cost + clip_ms()}), "timed")
    return (
        lookup_join(timed, stored(_turns(timed, limit_ms, floor_ms), "turns"), ["ord"], "inner")
        .where(F.col("__stop").isNull() | (F.col(SLOT) < F.col("__stop")))
        .withColumn("used_before_ms", F.col("__carried") + F.col("__before"))
        .select(*work.columns, "used_before_ms")
    )


def _turns(timed: DataFrame, limit_ms: int, floor_ms: int) -> DataFrame:
    """(ord, slot of the first row left out or NULL, used before) of the voices that begin."""
    voices = timed.groupBy("ord").agg(F.max("__after").alias("total"), F.max("__need").alias("peak"))
    summed = stored(running(voices, [], ["ord"], __sum=("sum", F.col("total"))).withColumn(
        "__carried", F.col("__sum") - F.col("total")), "voices")
    left = F.lit(limit_ms) - F.col("__carried")
    # One row: the first voice that cannot begin, or cannot end.
    first = summed.where((left < floor_ms) | (F.col("peak") > left)).agg(
        F.min(F.struct("ord", "__carried")).alias("v")).first()["v"]
    whole = summed if first is None else summed.where(F.col("ord") < first["ord"])
    turns = whole.select("ord", F.lit(None).cast("bigint").alias("__stop"), "__carried")
    if first is None or limit_ms - first["__carried"] < floor_ms:
        return turns
    at = timed.where((F.col("ord") == first["ord"]) & (F.col("__need") > limit_ms - first["__carried"])).agg(
        F.min(F.struct(SLOT, "__before")).alias("at")).first()["at"]
    used = first["__carried"] + at["__before"]
    here = timed.sparkSession.createDataFrame([(first["ord"], at[SLOT], first["__carried"])], _TURN)
    later = _later_turns(timed, first["ord"], limit_ms, used, floor_ms)
    return turns.unionByName(here) if later is None else turns.unionByName(here).unionByName(later)


class Step(NamedTuple):
    """What a voice takes: where need[k - 1] <= left < need[k], taken[k] up to slot[k]; no slot behind the last."""

    need: np.ndarray
    taken: np.ndarray
    slot: list[int | None]

    def at(self, left: int) -> tuple[int, int | None]:
        k = int(np.searchsorted(self.need, left, side="right"))
        return int(self.taken[k]), self.slot[k]


class Usage:
    """Of what is left in [floor, top], how much a row of voices takes: taken[k] from begin[k] on."""

    def __init__(self, floor: int, top: int):
        self.floor, self.top = floor, top
        self.begin, self.taken = np.array([floor], np.int64), np.zeros(1, np.int64)

    def then(self, step: Step) -> None:
        """One more voice behind; it begins only with `floor` left."""
        # Where the function of the voice has its steps, seen from what was left at the start.
        edges = np.sort(np.append(step.need, self.floor))
        ends = np.append(self.begin[1:], self.top + 1)
        low = np.searchsorted(edges, self.begin - self.taken, side="right")
        many = np.maximum(np.searchsorted(edges, ends - self.taken) - low, 0)
        piece = np.repeat(np.arange(len(many)), many)
        edge = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many) + low[piece]
        begin = np.concatenate((self.begin, edges[edge] + self.taken[piece]))
        taken = np.concatenate((self.taken, self.taken[piece]))
        order = np.argsort(begin, kind="stable")
        begin, taken = begin[order], taken[order]
        left = begin - taken
        taken = taken + np.where(left >= self.floor, step.taken[np.searchsorted(step.need, left, side="right")], 0)
        keep = np.diff(taken, prepend=-1) != 0
        self.begin, self.taken = begin[keep], taken[keep]

    def of(self, left: int) -> int:
        return int(self.taken[np.searchsorted(self.begin, left, side="right") - 1]) if left >= self.floor else 0


def _steps(rows: pa.Table) -> Iterator[tuple[int, Step]]:
    """The voices of some rows in turn; rows are the candidates for a stop and, with a NULL slot, the voice's total."""
    rows = rows.sort_by([("ord", "ascending"), (SLOT, "ascending")])
    order, slots = rows.column("ord").to_numpy(), rows.column(SLOT).to_pylist()
    need, before = rows.column("__need").to_pylist(), rows.column("__before").to_pylist()
    bounds = [0, *(np.flatnonzero(np.diff(order)) + 1).tolist(), len(order)] if len(order) else []
    for a, b in zip(bounds, bounds[1:]):
        needs, taken, stops, most, total = [], [], [], -1, 0
        for i in range(a, b):
            if slots[i] is None:
                total = before[i]
            elif need[i] > most:   # only a row that needs more than all before it can be the first that does not fit
                needs.append(need[i])
                taken.append(before[i])
                stops.append(slots[i])
                most = need[i]
        yield int(order[a]), Step(np.array(needs, np.int64), np.array([*taken, total], np.int64), [*stops, None])


def _later_turns(timed: DataFrame, after: int, limit_ms: int, used: int, floor_ms: int) -> DataFrame | None:
    """Turns of the voices behind one that stopped."""
    spark, top = timed.sparkSession, limit_ms - used
    if top < floor_ms:
        return None
    later = timed.where(F.col("ord") > after)
    # Rows that start within what is left; of those with the same amounts, as failures have, the first.
    near = later.where(F.col("__before") <= top).groupBy("ord", "__before", "__need").agg(F.min(SLOT).alias(SLOT))
    totals = later.groupBy("ord").agg(F.max("__after").alias("__before")).select(
        "ord", "__before", F.lit(None).cast("bigint").alias("__need"), F.lit(None).cast("bigint").alias(SLOT))
    ranged = near.unionByName(totals).repartitionByRange("ord").withColumn("__range", F.spark_partition_id())
    ranges = stored(ranged, "near")

    def compose(key: tuple, rows: pa.Table) -> pa.Table:
        usage = Usage(floor_ms, top)
        for _, step in _steps(rows):
            usage.then(step)
        raw = io.BytesIO()
        np.save(raw, np.stack([usage.begin, usage.taken]))
        return pa.table({"__range": pa.array([key[0].as_py()], pa.int32()), "usage": pa.array([raw.getvalue()], pa.binary())})

    composed = stored(ranges.groupBy("__range").applyInArrow(compose, "__range int, usage binary"), "usage")
    left, start = top, []
    usage = Usage(floor_ms, top)
    # One row per task, one at a time; a function has no more steps than milliseconds are left.
    for row in composed.orderBy("__range").toLocalIterator():
        start.append((row["__range"], left))
        usage.begin, usage.taken = np.load(io.BytesIO(row["usage"]))
        left -= usage.of(left)

    def walk(key: tuple, rows: pa.Table) -> pa.Table:
        now, out = rows.column("__left")[0].as_py(), []
        for order, step in _steps(rows):
            if now < floor_ms:
                break
            taken, slot = step.at(now)
            out.append((order, slot, limit_ms - now))
            now -= taken
        return pa.table([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], ["ord", "__stop", "__carried"])

    begun = spark.createDataFrame(start, "__range int, __left bigint")   # at most one row per partition
    return ranges.join(F.broadcast(begun.where(F.col("__left") >= floor_ms)), "__range").groupBy("__range").applyInArrow(
        walk, _TURN)


def budget_used(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count_if(F.col("error").isNull()).alias("ok"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.coalesce(F.sum(F.when(F.col("error").isNull(), clip_ms())), F.lit(0))
        .alias("used_ms"),
    )


def budget_estimate(limit_minutes: Column, mean_seconds: Column | None = None) -> Column:
    """How many clips of mean length a budget holds."""
    mean = F.lit(DEFAULT_CLIP_SECONDS) if mean_seconds is None else mean_seconds
    return F.try_divide(limit_minutes * 60, mean)
