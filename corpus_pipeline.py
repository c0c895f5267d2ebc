"""The corpus pipeline: each stage works on all that the one before it kept.

run() writes every stage's rows to the shared folder and reads them back, so a
lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.llm.common import documents
from clipledger.llm.line_dedup import drop_common_lines
from clipledger.llm.packing import pack_lengths
from clipledger.llm.quality_classifier import classify
from clipledger.llm.simhash import near_duplicates
from clipledger.llm.substring_dedup import remove_repeats
from clipledger.session import stored

ORACLE_SQL = None   # embeddings are learned and hashed; SQL has neither


def _with_text(df: DataFrame, text: str) -> DataFrame:
    return df.select("doc_id", F.col(text).alias("text"), "carried.lang", "carried.source",
                     F.char_length(text).cast("long").alias("n_chars"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for low quality go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = classify(docs, labels, threshold=0.3, carry=("text", "lang", "source", "n_chars"))
    return judged.where("predicted = 1").select(
        "doc_id", "carried.text", "carried.lang", "carried.source", "carried.n_chars")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; all documents stay."""
    return _with_text(drop_common_lines(docs, min_docs=10, carry=("lang", "source")), "kept_text")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    found = near_duplicates(docs, shingle=3, radius=3, carry=("text", "lang", "source", "n_chars"))
    return found.where("stays").select("doc_id", "carried.text", "carried.lang", "carried.source", "carried.n_chars")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that stand earlier go; all documents stay."""
    return _with_text(remove_repeats(docs, window=20, carry=("lang", "source"), rejoin=False), "kept_text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents in batches of like length."""
    return pack_lengths(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the table `documents`."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
