"""Manifest cells: parsing, blanks, backfill, timestamps, parameter stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.schema import (
    DOUBLE_FIELDS, FAKE, LONG_FIELDS, MANIFEST, MANIFEST_FIELDS, METHOD_LEGACY_REAL,
    METHOD_MODEL, MODEL_PARAMS, REAL, REQUIRED_FIELDS, TEXT_FIELDS, UNKNOWN_TIME,
)

# What a number may look like in a manifest cell.
_DIGITS = r"\d+(?:_\d+)*"
_LONG = rf"^\s*[+-]?{_DIGITS}\s*$"
_DOUBLE = (
    rf"^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)


def _number(cell: Column, pattern: str, to: str) -> Column:
    # Java would also take "1.5f" and SQL would cut "1.5" to an integer, so
    # the shape is tested before the cast.
    plain = F.replace(F.trim(cell), F.lit("_"), F.lit(""))
    return F.when(cell.rlike(pattern), plain.try_cast(to))


def parse_long(cell: Column) -> Column:
    return _number(cell, _LONG, "bigint")


def parse_double(cell: Column) -> Column:
    return _number(cell, _DOUBLE, "double")


def _missing(cell: Column) -> Column:
    return cell.isNull() | (cell == "")


def typed_or_reject(raw: DataFrame) -> DataFrame:
    """Text rows to typed rows plus `reject`: NULL, or why the row is refused."""
    have = set(raw.columns)
    cells = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in MANIFEST_FIELDS}
    parse = {**{c: parse_double for c in DOUBLE_FIELDS}, **{c: parse_long for c in LONG_FIELDS}}
    keep = [c for c in raw.columns if c not in MANIFEST_FIELDS]
    # Two steps, so that each number is parsed once and only looked at after.
    typed = raw.select(
        *keep,
        *[F.coalesce(cells[c], F.lit("")).alias(c) for c in TEXT_FIELDS],
        *[parse[c](cells[c]).alias(c) for c in parse],
        *[_missing(cells[c]).alias(f"__no_{c}") for c in parse],
    )
    reasons = [F.when(~F.col(f"__no_{c}") & F.col(c).isNull(), F.lit(c)) for c in parse]
    absent = [c for c in REQUIRED_FIELDS if c not in have]
    reject = F.lit(absent[0]) if absent else F.coalesce(*reasons)
    return typed.select(*keep, *MANIFEST_FIELDS, reject.alias("reject"))


def accepted(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("reject").isNull()).drop("reject")


def rejected(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("reject").isNotNull())


def as_text(manifest: DataFrame) -> DataFrame:
    """All columns as text in file order, NULL as blank."""
    return manifest.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in MANIFEST_FIELDS]
    )


def utc_stamp(at: Column | None = None) -> Column:
    """YYYY-MM-DDTHH:MM:SSZ of now, or of a time `at` that is in UTC already."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now if at is None else at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def stamped_at(generated_at: Column) -> Column:
    """The text stamp as a timestamp, NULL for blank or unknown."""
    return F.try_to_timestamp(generated_at, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


def backfill(manifest: DataFrame) -> DataFrame:
    """Legacy blanks filled in; `changed` tells whether the row had any."""
    no_method = (F.col("method") == "") & (F.col("label") == REAL)
    no_time = F.col("generated_at") == ""
    return manifest.withColumns({
        "changed": no_method | no_time,
        "method": F.when(no_method, METHOD_LEGACY_REAL).otherwise(F.col("method")),
        "generated_at": F.when(no_time, UNKNOWN_TIME).otherwise(F.col("generated_at")),
    })


def stamp_params(rows: DataFrame, params: dict | None = None) -> DataFrame:
    """Conversion parameters on model-converted rows, none on all others."""
    params = MODEL_PARAMS if params is None else params
    modelled = F.col("method") == METHOD_MODEL
    stamped = {
        c: F.when(modelled, F.lit(params[c])).cast(MANIFEST[c].dataType)
        for c in DOUBLE_FIELDS + LONG_FIELDS
    }
    stamped["f0_method"] = F.when(modelled, F.lit(params["f0_method"])).otherwise("")
    return rows.withColumns(stamped)


def entries(rows: DataFrame, label: str, method: Column | str, params: dict | None = None,
            generated_at: Column | str = "") -> DataFrame:
    """Manifest rows from `filename` and, where present, voice_model, source_file."""
    def cell(c: str) -> Column:
        return F.col(c) if c in rows.columns else F.lit("")

    def given(v: Column | str) -> Column:
        return F.lit(v) if isinstance(v, str) else v

    carried = [c for c in rows.columns if c not in MANIFEST_FIELDS]
    shaped = rows.select(
        *carried,
        F.col("filename"), cell("filepath").alias("filepath"), F.lit(label).alias("label"),
        given(method).alias("method"), cell("voice_model").alias("voice_model"),
        cell("source_file").alias("source_file"), given(generated_at).alias("generated_at"),
    )
    return stamp_params(shaped, params).select(*carried, *MANIFEST_FIELDS)


def is_real() -> Column:
    """Never NULL: a row without a label is not real."""
    return F.coalesce(F.col("label") == REAL, F.lit(False))


def is_fake() -> Column:
    return F.coalesce(F.col("label") == FAKE, F.lit(False))
