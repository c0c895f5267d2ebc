"""Clip durations from file headers, without reading the audio."""

from __future__ import annotations

import wave
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipledger.schema import DEFAULT_CLIP_SECONDS
from clipledger.sources.archives import default_file_system, located


def _seconds(path: str, default: str) -> tuple[float | None, str | None]:
    """(seconds, None), or (None, message) where the file cannot be read at all."""
    try:
        filesystem, name = located(path, default)
        raw = filesystem.open_input_file(name)
    except Exception as e:  # noqa: BLE001 - a missing file or a store out of reach is the row's error
        return None, str(e) or type(e).__name__
    with raw:
        try:
            with wave.open(raw, "rb") as clip:
                return clip.getnframes() / clip.getframerate(), None
        except (wave.Error, EOFError, ZeroDivisionError):
            return DEFAULT_CLIP_SECONDS, None   # a broken header
        except OSError as e:
            return None, str(e) or type(e).__name__


def with_file_seconds(clips: DataFrame) -> DataFrame:
    """Add `seconds` of the file at `path`, and `error`.

    A broken header means the default length.  A file that cannot be read has
    no length but an error, so that a wrong path or credential is seen.  Only
    the header chunks are fetched; binaryFile would load whole clips.
    """
    default = default_file_system(clips.sparkSession)
    schema = T.StructType([*clips.schema.fields, T.StructField("seconds", T.DoubleType()),
                           T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_seconds(p, default) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([s for s, _ in found], pa.float64()),
                 pa.array([e for _, e in found], pa.string())],
                names=[*batch.schema.names, "seconds", "error"])

    return clips.mapInArrow(run, schema)
