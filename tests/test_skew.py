"""The hot-key path of the joins gives what the plain path gives."""

import pytest
from compare import rows
from pyspark.sql import functions as F

from clipledger.operators import skew
from clipledger.operators.pending import set_difference, set_intersection
from clipledger.operators.skew import hot_hashes, lookup_join


@pytest.fixture()
def tables(spark):
    left = spark.createDataFrame(
        [("hot" if i % 3 == 0 else "void" if i % 3 == 1 else f"k{i}", i % 2, i) for i in range(3000)],
        "k string, v int, i int")
    right = spark.createDataFrame(
        [("hot", 0, "H0"), ("hot", 1, "H1"), *[(f"k{i}", i % 2, f"r{i}") for i in range(0, 3000, 5)],
         ("unused", 0, "u")], "k string, v int, r string")
    return left, right


@pytest.fixture()
def eager(monkeypatch):
    monkeypatch.setattr(skew, "SMALL_BYTES", -1)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows(tables, how, monkeypatch):
    left, right = tables
    plain = lookup_join(left, right, ["k", "v"], how)
    monkeypatch.setattr(skew, "SMALL_BYTES", -1)
    split = lookup_join(left, right, ["k", "v"], how)
    assert "Union" in split._jdf.queryExecution().toString()
    assert rows(split, *plain.columns) == rows(plain)


def test_finds_only_hot_keys(tables, eager):
    assert len(hot_hashes(tables[0], ["k"])) == 2
    assert hot_hashes(tables[0], ["i"]) == []
    assert hot_hashes(tables[0].where("i < 0"), ["k"]) == []


def test_a_key_of_half_a_percent_is_hot_for_400_partitions(spark, eager):
    df = spark.range(100_000).select(F.when(F.col("id") < 500, -1).otherwise(F.col("id")).alias("k"))
    assert hot_hashes(df, ["k"]) == []
    spark.conf.set("spark.sql.shuffle.partitions", 400)
    try:
        assert len(hot_hashes(df, ["k"])) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_difference_and_intersection(tables, eager):
    left, right = tables
    repeated = right.unionByName(right)
    out, kept = set_difference(left, repeated, "k"), set_intersection(left, repeated, "k")
    assert out.where("k = 'hot'").count() == 0 and out.where("k = 'void'").count() == 1000
    assert kept.where("k = 'hot'").count() == 1000
    assert out.count() + kept.count() == 3000


def test_nulls_have_no_match(spark, eager):
    left = spark.createDataFrame([(None, i) for i in range(900)] + [("a", 1)], "k string, i int")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(set_difference(left, right, "k").groupBy("k").count()) == [(None, 900)]
