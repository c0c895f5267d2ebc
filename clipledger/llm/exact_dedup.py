"""Equal texts by sorting their contents.

Rows are range-partitioned by sampled splitters on (leading characters, digest)
of the normalised text, sorted on disk as far as memory asks for it, and every
row is compared in full with the row before it.  A group with more rows than a
quarter of a partition is cut into slices by its identifiers before the sort;
the few slice heads are compared in full afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipledger.llm.common import ascii_lower, partitions
from clipledger.session import stored

LEAD = 32   # characters that order texts before their digests do; equality never rests on them


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  The row with the largest doc_id stays, of repeated rows one; a null
    id stays only where its group has no other.  Other columns are not read;
    an empty table gives an empty result.
    """
    rows = docs.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("norm"))
    rows = rows.withColumn("text_sha256", F.sha2("norm", 256))
    sizes = stored(rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "copies")
    total = docs.count()
    limit = max(total // (4 * partitions(docs)), 1)
    # Fewer than four groups for each partition have more than `limit` rows.
    hot = sizes.where(F.col("n") > limit).select("text_sha256", F.ceil(F.col("n") / limit).alias("slices"))
    rows = rows.join(F.broadcast(hot), "text_sha256", "left").select(
        "doc_id", "norm", "text_sha256", F.substring("norm", 1, LEAD).alias("lead"),
        F.when(F.col("slices").isNull(), 0).otherwise(
            F.lit(1) + F.pmod(F.xxhash64("doc_id"), F.col("slices"))).alias("slice"))
    place = ["lead", "text_sha256", "slice"]
    by_text = W.partitionBy(*place).orderBy("norm", "doc_id")
    laid = rows.repartitionByRange(*place).sortWithinPartitions(*place, "norm", "doc_id")
    runs = laid.withColumn(
        "new", F.when(F.lag("norm").over(by_text).eqNullSafe(F.col("norm")), 0).otherwise(1)
    ).withColumn("run", F.sum("new").over(by_text)).select(
        "doc_id", *place, "run",
        F.when((F.col("slice") > 0) & (F.col("new") == 1), F.col("norm")).alias("head"))
    run = W.partitionBy(*place, "run")
    sized = stored(runs.select(
        "doc_id", "text_sha256", "slice", "run", "head", F.max("doc_id").over(run).alias("largest"),
        F.count(F.lit(1)).over(run).alias("n"),
        F.row_number().over(run.orderBy(F.desc_nulls_last("doc_id"))).alias("nth")), "runs")
    # One head for each slice of the large groups: a few rows for each partition.
    joined = sized.where("head is not null").groupBy("text_sha256", "head").agg(
        F.max("largest").alias("keep_id"), F.sum("n").alias("group_size"),
        F.collect_list(F.struct("slice", "run")).alias("of"))
    slices = joined.select("text_sha256", F.explode("of").alias("of"), "keep_id", "group_size").select(
        "text_sha256", "of.slice", "of.run", "keep_id", "group_size")
    return sized.join(F.broadcast(slices), ["text_sha256", "slice", "run"], "left").select(
        "doc_id", F.coalesce("keep_id", "largest").alias("keep_id"),
        F.coalesce("group_size", "n").alias("group_size"),
        ((F.col("nth") == 1) & F.col("doc_id").eqNullSafe(F.coalesce("keep_id", "largest"))).alias("kept"),
        "text_sha256")
