"""Sentence and message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code points that count as blank around a sentence.
_BLANK_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
_BLANKS = "".join(chr(c) for first, last in _BLANK_RANGES for c in range(first, last + 1))


def clean_sentence(sentence: Column) -> Column:
    """Strip Unicode blanks at both ends (trim() alone knows U+0020 only).

    Looks at the ends of the text only; a regular expression would scan it.
    """
    return F.trim(sentence, F.lit(_BLANKS))


def char_count(sentence: Column) -> Column:
    """Length in code points."""
    return F.length(sentence).cast("bigint")


def retriable(message: Column) -> Column:
    return message.contains("429") | F.lower(message).contains("rate")
