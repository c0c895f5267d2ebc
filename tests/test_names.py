"""Renaming against the sequential rule, many random corpora in one table."""

import itertools
import random
from pathlib import PurePath

import pytest
from compare import rows

from clipledger.operators.names import (
    decollide_names, flatten_counts, next_index, sequence_assign,
)

SCHEMA = "entry_seq bigint, filename string, label string, voice_model string"


def wishes(filename, voice):
    """The names a fake asks for, best first."""
    own = PurePath(filename)
    voiced = PurePath(own.stem + "_" + voice.replace(" ", "_") + own.suffix)
    numbered = (f"{voiced.stem}_{k}{own.suffix}" for k in itertools.count(2))
    return itertools.chain([filename, voiced.name], numbered)


def one_by_one(entries):
    """The rule row after row: each takes the best name nobody had before."""
    final = {}
    for seq, filename, label, voice in sorted(entries):
        had = set(final.values())
        final[seq] = filename if label == "real" else next(
            n for n in wishes(filename, voice) if n not in had)
    return final


def check(spark, entries):
    got = decollide_names(spark.createDataFrame(entries, SCHEMA)).collect()
    assert len(got) == len(entries)
    want = one_by_one(entries)
    assert {r.entry_seq: r.name for r in got} == want
    assert all(r.renamed == (r.name != r.filename) for r in got)
    return want


def corpora(seed, count, stems, voices, exts, size):
    rng, out, seq = random.Random(seed), [], 0
    for c in range(count):
        for _ in range(rng.randrange(1, size)):
            stem, ext = rng.choice(stems), rng.choice(exts)
            label = rng.choice(["real", "fake", "fake", "fake"])
            out.append((seq, f"c{c}-{stem}{ext}", label, rng.choice(voices)))
            seq += rng.randrange(1, 4)
    rng.shuffle(out)
    return out


def test_real_first_then_fakes(spark):
    want = check(spark, [(0, "a.wav", "real", ""), (1, "a.wav", "fake", "v w"),
                         (2, "a.wav", "fake", "v w"), (3, "a.wav", "fake", "v w"),
                         (4, "a.wav", "fake", "u"), (5, "a.wav", "real", "")])
    assert want == {0: "a.wav", 1: "a_v_w.wav", 2: "a_v_w_2.wav", 3: "a_v_w_3.wav",
                    4: "a_u.wav", 5: "a.wav"}


def test_fake_first_keeps_its_name(spark):
    assert check(spark, [(0, "a.wav", "fake", "v"), (1, "a.wav", "real", "")]) == {
        0: "a.wav", 1: "a.wav"}


def test_random_without_meetings(spark):
    check(spark, corpora(1, 60, ["a", "b"], ["x", "y z"], [".wav"], 14))


def test_random_with_meetings(spark):
    """Own names equal to names with a voice or a number, in any order."""
    stems = ["a", "a_x", "a_x_2", "a_x_3", "a_2", "a_2_x", "a_x_x", "a_x_2_x"]
    check(spark, corpora(2, 150, stems, ["x", "2", "x_2", "x 2"], [".wav"], 16))


def test_random_odd_names(spark):
    stems = ["a", "a.x", ".a", "a_x.y", "a_x", "a."]
    check(spark, corpora(3, 100, stems, ["x", "x.y", "x.wav"], [".wav", "", ".mp3"], 12))


def test_flattened_before(spark):
    """Hundreds of names taken by an earlier run take no round each."""
    old = [(0, "a.wav", "real", ""), (1, "a_v.wav", "fake", "v")]
    old += [(i, f"a_v_{i}.wav", "fake", "v") for i in range(2, 400) if i % 7]
    new = [(1000 + i, "a.wav", "fake", "v") for i in range(100)]
    want = check(spark, old + new)
    assert want[1000] == "a_v_7.wav" and want[1099] == f"a_v_{399 + 100 - 57}.wav"


@pytest.fixture()
def rounds(monkeypatch):
    """Counts how often names are contested."""
    from clipledger.operators import names

    calls, climb = [], names._climb
    monkeypatch.setattr(names, "_climb", lambda *a: calls.append(1) or climb(*a))
    return calls


def test_found_again_after_flattening(spark, rounds):
    """An old row comes before hundreds of taken names, new rows after them."""
    old = [(0, "a.wav", "real", ""), (1, "a.wav", "fake", "v")]
    taken = [(10 + i, f"a_v_{i}.wav", "fake", "v") for i in range(2, 400) if i % 3]
    new = [(1000 + i, "a.wav", "fake", "v") for i in range(200)]
    check(spark, old + taken + new)
    assert len(rounds) <= 3


def test_old_and_new_rows_in_turns(spark, rounds):
    turns = [(0, "a.wav", "real", "")]
    for i in range(2, 120):
        turns += [(2 * i, f"a_v_{i}.wav", "fake", "v"), (2 * i + 1, "a.wav", "fake", "v")]
    check(spark, turns)
    assert len(rounds) <= 5


@pytest.mark.parametrize("stored, want", [
    ([], 0),
    ([("tagarela_000004.wav", "tagarela"), ("tagarela_000001.wav", "tagarela")], 5),
    ([("tagarela_1000000.wav", "tagarela")], 1_000_001),
    ([("tagarela_000009.wav", ""), ("tagarela_x.wav", "tagarela"), ("x.wav", "tagarela")], 0),
])
def test_next_index(spark, stored, want):
    df = spark.createDataFrame(stored, "filename string, method string")
    assert next_index(df).first()["next_index"] == want


def test_sequence_assign(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    assert rows(sequence_assign(df, 999_999, "s"), "s", "filename") == [
        ("a", "tagarela_999999.wav"), ("b", "tagarela_1000000.wav"), ("c", "tagarela_1000001.wav")]


def test_flatten_counts(spark):
    moves = spark.createDataFrame(
        [("real", "real/a.wav", "real/a.wav", False), ("fake", "fake/v/a.wav", "fake/a_v.wav", True)],
        "label string, path string, filepath string, renamed boolean")
    missing = spark.createDataFrame([(1,)], "entry_seq int")
    assert rows(flatten_counts(moves, missing)) == [(2, 1, 1, 1, 1, 1, 1)]
