"""Voice catalogues: from model folders, a configured list, or a text spec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions.paths import parent_name, suffix
from clipledger.operators.ordering import global_position
from clipledger.schema import VOICES
from clipledger.sources.folders import exists, listing


def catalogue(files: DataFrame) -> DataFrame:
    """Folders with a .pth and an .index file: (voice, model_path, index_path, model_bytes).

    The first path of each kind is taken.
    """
    kind = suffix("path")
    model = F.when(kind == ".pth", F.struct("path", "length"))
    return files.groupBy(parent_name("path").alias("voice")).agg(
        F.min(model).alias("model"),
        F.min(F.when(kind == ".index", F.col("path"))).alias("index_path"),
    ).where(F.col("model").isNotNull() & F.col("index_path").isNotNull()).select(
        "voice", F.col("model.path").alias("model_path"), "index_path",
        F.col("model.length").alias("model_bytes"))


def model_voices(spark: SparkSession, models_dir: str, only: list[str] | None = None) -> DataFrame:
    """The catalogue of a models folder in name order, with `ord`; none is an error."""
    if not exists(spark, models_dir):
        raise FileNotFoundError(f"no such folder: {models_dir}")
    found = catalogue(listing(spark, f"{models_dir.rstrip('/')}/*", "*.{pth,index}"))
    if only:
        found = found.where(F.col("voice").isin(only))
    if found.isEmpty():
        raise FileNotFoundError(f"no voice with a model and an index in {models_dir}")
    return global_position(found, "voice", name="ord")


def with_size_mb(voices: DataFrame) -> DataFrame:
    return voices.withColumn("model_mb", F.col("model_bytes") / (1024 * 1024))


def configured_voices(spark: SparkSession, voices: list[dict],
                      only: list[str] | None = None) -> DataFrame:
    """Voices listed in a configuration, in their order."""
    chosen = [v for v in voices if not only or v["name"] in only]
    if not chosen:
        raise ValueError("no configured voice matches")
    return spark.createDataFrame(
        [(i, v["name"], v["voice_id"]) for i, v in enumerate(chosen)], VOICES)


def parse_voice_spec(rows: DataFrame, spec: Column) -> DataFrame:
    """Expand "name:id,name:id" to (…, ord, voice, voice_id); a bad pair is fatal."""
    pairs = rows.select("*", F.posexplode(F.split(spec, ",")).alias("ord", "pair"))
    pair = F.trim("pair")
    halves = F.split(pair, ":", 2)
    checked = F.when(pair.contains(":"), halves).otherwise(
        F.raise_error(F.concat(F.lit("expected name:voice_id, got "), pair)).cast("array<string>"))
    return pairs.withColumn("halves", checked).select(
        *rows.columns, F.col("ord").cast("bigint").alias("ord"),
        F.trim(F.col("halves")[0]).alias("voice"), F.trim(F.col("halves")[1]).alias("voice_id"))


def spec_voices(spark: SparkSession, spec: str) -> DataFrame:
    one = spark.range(1).select(F.lit(spec).alias("spec"))
    return parse_voice_spec(one, F.col("spec")).select("ord", "voice", "voice_id")
