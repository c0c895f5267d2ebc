"""Session settings and the shared folder for stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "clipledger", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    A local session without that setting gets it set to a temporary folder; on
    a cluster a machine-local folder would be lost with its machine, so there a
    missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if named:
        return f"{named.rstrip('/')}/clipledger-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    # One machine is all there is; the setting is made, so that every reader of it agrees.
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clipledger-"))
    return shared_folder(spark)


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str = "stored") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors, and later reads
    prune columns and row groups.
    """
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables that `stored` wrote in this application."""
    from clipledger.sources.folders import delete

    delete(spark, shared_folder(spark))


