"""Batches of rows that ask questions about the whole table by keys.

Rows are packed, without a shuffle, into stored batches of bounded bytes.  A
batch sends each distinct key once, however often its rows have it, to the part
that owns the key; a part sees one message of each batch, so a key that a third
of all rows hold counts once per batch.  The part answers in the order of the
message, and the answers meet their batch again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.session import stored

BATCH_BYTES = 4 << 20    # text in a batch; a longer text has one of its own
PART_BYTES = 16 << 20    # text whose keys one part owns, on average


def pack(rows: DataFrame, size_column: str = "text", tag: str = "batches", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A stored table of batches: batch, bytes, rows and blob (compressed Arrow stream of the rows)."""
    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        size = 0

        def full():
            table = pa.Table.from_batches(held).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([base + number]), pa.array([size]), pa.array([table.num_rows]),
                 pa.array([to_blob(table)], pa.binary())], ["batch", "bytes", "rows", "blob"])

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(size_column)), 0).to_pylist()
            first = 0
            for i, n in enumerate(lengths):
                if size and size + n > batch_bytes:
                    if i > first:
                        held.append(batch.slice(first, i - first))
                    yield full()
                    held, size, first, number = [], 0, i, number + 1
                size += n + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield full()

    return stored(rows.mapInArrow(run, "batch bigint, bytes bigint, rows bigint, blob binary"), tag)


def to_blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def from_blob(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_all()


def parts_for(batches: DataFrame) -> int:
    total = batches.agg(F.sum("bytes")).first()[0] or 0
    return max(4 * int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PART_BYTES)


def ask(batches: DataFrame, request: Callable[..., Iterator[tuple[int, bytes]]],
        answer: Callable[[list[bytes]], list[bytes]], extra: tuple[str, ...] = ()) -> DataFrame:
    """Answers to the messages of all batches: batch, part, payload.

    request(rows, *extra values) yields (part, message) for one batch;
    answer(messages, in the order of their batches) gives one reply for each
    message of a part, and may add a summary, which counts as batch -1.
    """
    def send(stream):
        for table in stream:
            for row in (table.slice(i, 1).to_pylist()[0] for i in range(table.num_rows)):
                sent = list(request(from_blob(row["blob"]), *[row[c] for c in extra]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["batch"]] * len(sent), pa.int64()), pa.array([p for p, _ in sent], pa.int32()),
                     pa.array([m for _, m in sent], pa.binary())], ["batch", "part", "payload"])
                del sent
                pa.default_memory_pool().release_unused()   # the worker lives on beside the next stages

    def reply(table: pa.Table) -> pa.Table:
        table = table.sort_by("batch")   # not the order of arrival, which another attempt may change
        replies = answer(table.column("payload").to_pylist())
        batch = (table.column("batch").to_pylist() + [-1])[: len(replies)]
        return pa.table({"batch": pa.array(batch, pa.int64()), "payload": pa.array(replies, pa.binary()),
                         "part": pa.array([table.column("part")[0].as_py()] * len(replies), pa.int32())}).select(
            ["batch", "part", "payload"])

    kind = "batch bigint, part int, payload binary"
    return batches.select("batch", "blob", *extra).mapInArrow(send, kind).groupBy("part").applyInArrow(reply, kind)


def inform(batches: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Batches with a further column: the replies to each, by part."""
    told = answers.groupBy("batch").agg(
        F.map_from_entries(F.collect_list(F.struct("part", "payload"))).alias(name))
    return batches.join(told, "batch", "left")


def owners(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the keys of each part begin among sorted 64-bit keys."""
    part = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)   # keeps the order of the keys
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def tell(batches: DataFrame, answers: DataFrame, work: Callable[..., pa.Table], schema: str,
         extra: tuple[str, ...] = ()) -> DataFrame:
    """work(rows, {part: reply}, *extra values) for each batch; it may return rows of `schema` or none."""
    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        replies = dict(zip(told.column("part").to_pylist(), told.column("payload").to_pylist()))
        out = work(from_blob(row["blob"]), replies, *[row[c] for c in extra])
        pa.default_memory_pool().release_unused()
        return out

    return batches.select("batch", "blob", *extra).groupBy("batch").cogroup(
        answers.groupBy("batch")).applyInArrow(run, schema)
