"""Plain versions of the operators, for small tables."""

import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
LAST = (1 << 63) - 1


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(LOW)


def ordered(rows):
    return sorted(rows, key=lambda r: [(c is not None, str(type(c)), str(c)) for c in r])


def same(df, expected, *columns):
    got = ordered(tuple(r) for r in df.select(*columns).collect())
    assert got == ordered(expected)
