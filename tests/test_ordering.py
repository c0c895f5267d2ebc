"""Positions and running totals against brute force, with a hot group."""

import random

import pytest
from compare import rows
from pyspark.sql import functions as F

from clipledger.operators import ordering
from clipledger.operators.ordering import (
    global_position, keep_first, keep_last, running, take_first,
)
from clipledger.operators.pending import limit_per_voice


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    out = []
    for i in range(3000):
        group = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None, "é", ""])
        out.append((group, i * 7 % 3000, rng.randrange(100)))
    return out


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "g string, k bigint, v bigint")


def test_position_follows_the_order(df, data):
    got = rows(global_position(df, "v", "k", start=10), "v", "k", "pos")
    want = [(v, k, i + 10) for i, (v, k) in enumerate(sorted((v, k) for _, k, v in data))]
    assert sorted(got) == want


def test_position_of_nothing(df):
    assert global_position(df.where("k < 0"), "k").count() == 0


def test_strings_sort_by_code_point(spark):
    names = ["b", "B", "é", "z", "￿", "𐀀", "a"]
    got = global_position(spark.createDataFrame([(n,) for n in names], "n string"), "n")
    assert [r.n for r in sorted(got.collect(), key=lambda r: r.pos)] == sorted(names)


def test_running_totals(df, data):
    out = running(df, ["g"], ["k"], n=("count", F.lit(1)), s=("sum", "v"), m=("max", "v"))
    state, want = {}, []
    for g, k, v in sorted(data, key=lambda r: r[1]):
        n, s, m = state.get(g, (0, 0, -1))
        state[g] = n + 1, s + v, max(m, v)
        want.append((g, k, *state[g]))
    assert sorted(rows(out, "g", "k", "n", "s", "m"), key=lambda r: r[1]) == want


def test_hot_group_spans_ranges(df):
    laid = ordering._laid_out(df, ["g", "k"]).where("g = 'hot'")
    assert laid.select("__range").distinct().count() > 2


def test_no_single_partition_in_the_main_plan(df):
    plan = running(df, ["g"], ["k"], n=("count", F.lit(1)))._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("n", [0, 1, 700, 5000])
def test_take_first_both_ways(df, n, monkeypatch):
    want = rows(take_first(df, n, "k"), "k")
    monkeypatch.setattr(ordering, "TOP_K_ROWS", -1)
    assert rows(take_first(df, n, "k"), "k") == want
    assert len(want) == min(n, 3000)


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")],
                               "k string, o int, v string")
    assert rows(keep_first(df, ["k"], "o"), "k", "v") == [("a", "x"), ("b", "z")]
    assert rows(keep_last(df, ["k"], "o"), "k", "v") == [("a", "y"), ("b", "z")]


@pytest.mark.parametrize("limit", [None, 0, 3, 1200])
def test_limit_per_voice(df, data, limit):
    named = df.where("g is not null").withColumnRenamed("g", "voice")
    got = rows(limit_per_voice(named, limit, "k"), "voice", "k")
    want, seen = [], {}
    for g, k, _ in sorted((r for r in data if r[0] is not None), key=lambda r: r[1]):
        seen[g] = seen.get(g, 0) + 1
        if limit is None or seen[g] <= limit:
            want.append((g, k))
    assert sorted(got) == sorted(want)


def test_negative_limit_is_refused(df):
    with pytest.raises(ValueError):
        limit_per_voice(df.withColumnRenamed("g", "voice"), -1, "k")
