"""Rows of a stream whose key was never seen before, by keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

KEY = "__key"
ARRIVAL = ("__at", "__file", "__row")   # order of arrival: time and path of the file, row in it
_NAMELESS = "\0"                        # begins the keys of rows that nothing identifies
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSeen(StatefulProcessor):
    """Lets the first row of a key pass, in the order of arrival, and remembers the key."""

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0].startswith(_NAMELESS):
            yield from rows
            return
        if self.seen.exists():
            return
        first = None
        for row in rows:
            if first is None or [row[c] for c in ARRIVAL] < [first[c] for c in ARRIVAL]:
                first = row
        self.seen.update((True,))
        yield first

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def first_seen(stream: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Rows with a new `key`, the first to arrive of each; rows with a blank or NULL key all pass.

    stream: with the column `arrival` of a file stream.  known: keys that count
    as seen when the state is first made; later starts find them in the state.
    Which rows pass does not depend on how the files are cut into batches.
    """
    if "arrival" not in stream.columns:
        raise ValueError("the stream has no column `arrival`")
    name = F.coalesce(F.col(key), F.lit(""))
    own = F.concat_ws("/", F.lit(_NAMELESS), "arrival.file", F.col("arrival.row").cast("string"))
    keyed = stream.withColumns({
        KEY: F.when(name == "", own).otherwise(name), ARRIVAL[0]: F.unix_micros("arrival.at"),
        ARRIVAL[1]: F.col("arrival.file"), ARRIVAL[2]: F.col("arrival.row")}).drop("arrival")
    seeds = known.select(F.col(key).alias(KEY)).where(F.coalesce(F.col(KEY), F.lit("")) != "").distinct()
    return keyed.groupBy(KEY).transformWithState(
        FirstSeen(), outputStructType=keyed.schema, outputMode="Append", timeMode="None",
        initialState=seeds.groupBy(KEY)).drop(KEY)


@contextmanager
def keyed_state(spark: SparkSession):
    """A stream started inside keeps its state where keyed state needs it."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def drain(batch: DataFrame) -> None:
    """Run a batch whose rows are not wanted, so that its state is kept all the same."""
    batch.write.format("noop").mode("overwrite").save()
