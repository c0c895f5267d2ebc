"""Signals held as arrays, and durations read from audio headers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipledger.schema import CLIP_WINDOW_MS, DEFAULT_CLIP_SECONDS


def downmix(frames: Column) -> Column:
    """Mean over channels, in single precision like the stored signal."""
    def mean(frame: Column) -> Column:
        total = F.aggregate(
            frame, F.lit(0).cast("float"), lambda acc, x: (acc + x).cast("float")
        )
        return (total / F.size(frame)).cast("float")

    return F.transform(frames, mean)


def quantise(signal: Column) -> Column:
    """Scale by 32767, clip to 16 bits, truncate toward zero; NaN becomes 0."""
    def level(x: Column) -> Column:
        scaled = (x * F.lit(32767)).cast("float")
        clipped = F.greatest(F.least(scaled, F.lit(32767).cast("float")),
                             F.lit(-32768).cast("float"))
        return F.when(F.isnan(x), F.lit(0).cast("smallint")).otherwise(clipped.cast("smallint"))

    return F.transform(signal, level)


def centre_clip(signal: Column, rate: int, window_ms: int = CLIP_WINDOW_MS) -> Column:
    """The middle `window_ms` of a signal, or all of it if it is shorter."""
    length_ms = F.bround(F.size(signal) * F.lit(1000.0) / F.lit(float(rate)), 0).cast("bigint")
    start_ms = F.greatest(
        F.lit(0).cast("bigint"),
        F.floor(length_ms / 2).cast("bigint") - F.lit(window_ms // 2),
    )
    end_ms = F.least(start_ms + F.lit(window_ms), length_ms)

    def sample(ms: Column) -> Column:
        return F.floor(ms * F.lit(rate) / F.lit(1000)).cast("int")

    return F.slice(signal, sample(start_ms) + 1, sample(end_ms) - sample(start_ms))


_FEW_CHUNKS = 16   # chunks walked before the length of the content is looked at

# Fixed value: the identifier of PCM in an extensible format chunk.
_PCM_SUBFORMAT = "0100000000001000800000AA00389B71"


# Bytes from the start of a chunk that a step looks at: to the end of an extensible subformat.
_CHUNK_HEAD = 48


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once a row, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def _le(digits: Column, at: int, size: int) -> Column:
    """Little-endian unsigned integer of `size` bytes at 0-based byte `at` of hexadecimal digits."""
    pairs = [F.substring(digits, 2 * (at + i) + 1, 2) for i in range(size)]
    return F.conv(F.concat(*reversed(pairs)), 16, 10).try_cast("bigint")


def riff_seconds(content: Column) -> Column:
    """Seconds of a PCM file by its chunks; NULL if it is not one.

    Chunks before the samples are stepped over, each padded to an even size;
    the format chunk has to come first, as plain or extensible PCM.  `content`
    need not reach beyond the head of the data chunk, and is computed once.
    """
    return _bound(content, _walked_seconds)


def _walked_seconds(content: Column) -> Column:
    length = F.octet_length(content)

    def digits(at: Column, size: int) -> Column:
        # Behind the end there is nothing, however far a broken size leads.
        return F.hex(F.substring(content, F.least(at, length).cast("int") + 1, size))

    def is_mark(head: Column, text: str) -> Column:
        return F.substring(head, 1, 8) == text.encode().hex().upper()

    def after(state: Column, head: Column, size: Column) -> Column:
        at = state["at"]
        inside = at + 8 <= length
        is_format, is_data = inside & is_mark(head, "fmt "), inside & is_mark(head, "data")
        # Fixed value: the extensible tag, and the PCM subformat behind it.
        extensible = (_le(head, 8, 2) == 0xFFFE) & (F.substring(head, 65, 32) == _PCM_SUBFORMAT)
        frame = _le(head, 10, 2) * F.floor((_le(head, 22, 2) + 7) / 8)
        return F.struct(
            (at + 8 + size + size % 2).alias("at"), (~inside | is_data | size.isNull()).alias("done"),
            F.when(is_format, _le(head, 12, 4)).otherwise(state["rate"]).alias("rate"),
            F.when(is_format, F.when((_le(head, 8, 2) == 1) | extensible, frame)).otherwise(state["frame"]).alias("frame"),
            F.when(is_data, size).alias("data"))

    def walked(state: Column, _: Column) -> Column:
        step = _bound(digits(state["at"], _CHUNK_HEAD), lambda head: _bound(
            _le(head, 4, 4), lambda size: after(state, head, size)))
        return F.when(state["done"], state).otherwise(step)

    long = "bigint"
    start = F.struct(F.lit(12).cast(long).alias("at"), F.lit(False).alias("done"), F.lit(None).cast(long).alias("rate"),
                     F.lit(None).cast(long).alias("frame"), F.lit(None).cast(long).alias("data"))
    # The data chunk is among the first chunks of nearly every file.  A chunk has eight bytes at least, so no
    # file has more than the second number of steps; they are taken only where the first ones did not end.
    few = F.aggregate(F.sequence(F.lit(1), F.lit(_FEW_CHUNKS)), start, walked)
    all_steps = F.sequence(F.lit(1), F.greatest(F.floor(length / 8).cast("int"), F.lit(1)))
    end = _bound(few, lambda s: F.when(s["done"], s).otherwise(F.aggregate(all_steps, s, walked)))
    seconds = _bound(end, lambda e: F.try_divide(F.floor(F.try_divide(e["data"], e["frame"])), e["rate"]))
    head = F.hex(F.substring(content, 1, 12))
    riff = is_mark(head, "RIFF") & (F.substring(head, 17, 8) == b"WAVE".hex().upper())
    return F.when(riff, seconds)


def seconds_or_default(seconds: Column) -> Column:
    return F.coalesce(seconds, F.lit(DEFAULT_CLIP_SECONDS))


def seconds_to_ms(seconds: Column) -> Column:
    """Whole milliseconds, so that running sums do not depend on order."""
    return F.round(seconds * 1000).cast("bigint")
