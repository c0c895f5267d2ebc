"""Every bound query against its SQL on the same tables."""

import pytest
from compare import connect, difference

from clipledger.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() >= 0


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = QUERIES["pending_large"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_first_per_key_is_limited_before_the_shuffle(spark, sf_dir):
    plan = QUERIES["limit_per_voice"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
