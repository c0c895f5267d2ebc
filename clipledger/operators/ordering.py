"""Positions and running totals in a total order, without a one-task window.

A window over the whole table, or over a group that holds a third of it, is
one task.  Here the rows are range-partitioned on (group, order), numbered
inside their range, and stored; a range then needs only the totals of the
ranges before it.  A hot group is spread over as many ranges as its rows fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipledger.session import stored

SLOT = "__slot"      # grows along the order; range number above bit 33
_RANGE = "__range"
_IN_RANGE = (1 << 33) - 1
TOP_K_ROWS = 100_000   # rows that may meet in one task for a top-k


def _laid_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` in key order with SLOT; keys must identify a row.

    The numbering is stored because a second evaluation of the range exchange
    may sample other bounds.
    """
    laid = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(SLOT, F.monotonically_increasing_id())
    )
    return stored(laid, "ordered").withColumn(_RANGE, F.shiftright(SLOT, 33))


def global_position(df: DataFrame, *keys: str, name: str = "pos", start: int = 0) -> DataFrame:
    """Add the position of each row in the order of `keys`, from `start`."""
    laid = _laid_out(df, list(keys))
    before = W.orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    # One row per range, so the offsets have at most shuffle.partitions rows.
    offsets = laid.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("__rows")).select(
        _RANGE, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    return (
        laid.join(F.broadcast(offsets), _RANGE)
        .withColumn(name, F.lit(start) + F.col("__offset") + F.col(SLOT).bitwiseAND(_IN_RANGE))
        .drop(SLOT, _RANGE, "__offset")
    )


def running(df: DataFrame, group: list[str], order: list[str], keep_slot: bool = False,
            **totals: tuple[str, Column | str]) -> DataFrame:
    """Add running totals per group up to and including each row.

    totals: name=(kind, value) with kind count, sum or max.
    """
    laid = _laid_out(df, group + order)
    here = W.partitionBy(_RANGE, *group).orderBy(SLOT).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*group).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    fold = {"count": F.count, "sum": F.sum, "max": F.max}
    gather = {"count": F.sum, "sum": F.sum, "max": F.max}

    def value(v: Column | str) -> Column:
        return F.col(v) if isinstance(v, str) else v

    part = {n: fold[k](value(v)).alias(f"__t_{n}") for n, (k, v) in totals.items()}
    carry = (
        laid.groupBy(_RANGE, *group).agg(*part.values())
        .select(
            F.col(_RANGE).alias("__r"), *[F.col(g).alias(f"__g_{g}") for g in group],
            *[gather[k](f"__t_{n}").over(earlier).alias(f"__c_{n}") for n, (k, _) in totals.items()],
            F.row_number().over(W.partitionBy(*group).orderBy(_RANGE)).alias("__nth"),
        )
        # Only the first group of a range can have begun in an earlier one, so
        # at most one row per range is left to broadcast.
        .where("__nth > 1").drop("__nth")
    )
    same = F.col(_RANGE) == F.col("__r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    out = laid.select(
        "*", *[fold[k](value(v)).over(here).alias(f"__l_{n}") for n, (k, v) in totals.items()]
    ).join(F.broadcast(carry), same, "left")
    combine = {
        "count": lambda a, b: a + F.coalesce(b, F.lit(0)),
        "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        "max": lambda a, b: F.greatest(a, b),
    }
    result = [combine[k](F.col(f"__l_{n}"), F.col(f"__c_{n}")).alias(n)
              for n, (k, _) in totals.items()]
    return out.select(*df.columns, *([SLOT] if keep_slot else []), *result)


def meets_in_one_task(df: DataFrame, n: int) -> bool:
    """Whether `n` rows from each task are few enough for one task."""
    return n * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) <= TOP_K_ROWS


def tie_break(df: DataFrame, *keys: str) -> Column:
    """A further key, so that rows with equal `keys` are in one order whatever the plan.

    It is a hash of all other columns that can be hashed; rows it does not
    tell apart are equal.
    """
    def flat(kind: T.DataType) -> bool:
        return not (isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and not flat(kind.elementType)
                    or isinstance(kind, T.StructType) and not all(flat(f.dataType) for f in kind))

    others = [f"`{f.name}`" for f in df.schema if f.name not in keys and flat(f.dataType)]
    return F.xxhash64(*others) if others else F.lit(0).cast("bigint")


def take_first(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first `n` rows in key order, ties in one order too; a large `n` stays distributed."""
    tied = df.withColumn("__tie", tie_break(df, *keys))
    if meets_in_one_task(df, n):
        return tied.orderBy(*keys, "__tie").limit(max(n, 0)).drop("__tie")
    return global_position(tied, *keys, "__tie", name="__pos").where(F.col("__pos") < n).drop("__pos", "__tie")


def keep_first(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """One row per key, the first in `order`.

    Catalyst limits each group before the shuffle, so a hot key sends one row
    per task.
    """
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def keep_last(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return keep_first(df, keys, *[F.col(c).desc() for c in order])
