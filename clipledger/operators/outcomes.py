"""Running a function over rows with errors as values, and reading attempt logs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clipledger.functions.text import retriable
from clipledger.operators.ordering import global_position
from clipledger.schema import BACKOFF_SECONDS, MAX_ATTEMPTS
from clipledger.session import stored


def convert_rows(df: DataFrame, convert: Callable[[object, dict], dict], added: T.StructType,
                 setup: Callable[[], object] | None = None) -> DataFrame:
    """Add the columns `convert(context, row)` returns, and `error`.

    `setup` runs once per task.  A row whose call raises gets the message in
    `error` and NULLs; it never stops the others.  Store the result before
    reading it more than once, or the function runs again.  The columns of
    `df` pass through as they are; the function sees plain Python values.
    """
    schema = T.StructType([*df.schema.fields, *added.fields,
                           T.StructField("error", T.StringType())])
    names = [f.name for f in added.fields]
    made_types = to_arrow_schema(T.StructType(schema.fields[len(df.schema):]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = setup() if setup else None
        for batch in batches:
            values: dict[str, list] = {n: [] for n in [*names, "error"]}
            for row in batch.to_pylist():
                try:
                    made, error = convert(context, row), None
                except Exception as e:  # noqa: BLE001 - any failure is the row's own
                    made, error = {}, str(e) or type(e).__name__
                for n in names:
                    values[n].append(made.get(n))
                values["error"].append(error)
            new = [pa.array(values[f.name], f.type) for f in made_types]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *values])

    return df.mapInArrow(run, schema)


def with_error(df: DataFrame, check: Column, message: Column | str) -> DataFrame:
    """Native counterpart: `error` where the check fails."""
    text = F.lit(message) if isinstance(message, str) else message
    return df.withColumn("error", F.when(~F.coalesce(check, F.lit(False)), text))


def successes(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("error").isNull()).drop("error")


def failures(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("error").isNotNull())


def error_log(outcomes: DataFrame, at: Column) -> DataFrame:
    """Rows of the error table with the line the text log would show."""
    return failures(outcomes).select(
        "voice", "filename", "error", at.alias("at"),
        F.concat_ws("|", "voice", "filename", "error").alias("line"))


def convert_until(work: DataFrame, wanted: int, convert: Callable[[DataFrame], DataFrame],
                  *order: str) -> DataFrame | None:
    """Outcomes of the first rows in order that give `wanted` successes.

    As many rows are converted as successes are missing, and again for those
    that failed; rows after the last success are not touched.  Keep payloads
    out of `work` and let `convert` fetch them.
    """
    placed = global_position(work, *order, name="__pos")
    total, begin, good, outcomes = placed.count(), 0, 0, None
    while good < wanted and begin < total:
        end = begin + wanted - good
        part = placed.where((F.col("__pos") >= begin) & (F.col("__pos") < end)).drop("__pos")
        done = stored(convert(part), "converted")
        outcomes = done if outcomes is None else outcomes.unionByName(done)
        good += done.where(F.col("error").isNull()).count()
        begin = end
    return outcomes


def resolve_attempts(attempts: DataFrame, *keys: str) -> DataFrame:
    """State of each file from its attempts (attempt from 1, error or NULL).

    A success or a failure that is not retriable is final, and so is the last
    allowed attempt; attempts after a final one do not count.  Without a final
    attempt the file is open.  The wait grows with each retry.
    """
    final = (
        F.col("error").isNull() | ~retriable(F.col("error")) | (F.col("attempt") >= MAX_ATTEMPTS)
    )
    seen = attempts.where(F.col("attempt") <= MAX_ATTEMPTS).groupBy(*keys).agg(
        F.min(F.when(final, F.struct("attempt", "error"))).alias("end"),
        F.max("attempt").alias("last"),
    )
    retries = F.when(F.col("end").isNull(), F.least(F.col("last"), F.lit(MAX_ATTEMPTS - 1))
                     ).otherwise(F.col("end.attempt") - 1).cast("bigint")
    return seen.select(
        *keys,
        F.when(F.col("end").isNull(), "open").when(F.col("end.error").isNull(), "ok")
        .otherwise("failed").alias("status"),
        F.coalesce(F.col("end.attempt"), F.col("last")).cast("bigint").alias("attempts"),
        F.col("end.error").alias("error"),
        (retries * (retries + 1) * BACKOFF_SECONDS / 2).cast("bigint").alias("waited_s"),
    )
