"""Every registered query beside its SQL in DuckDB, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from parity.compare import compare, connect
from parity.registry import SPARK, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SPARK))
def test_query_matches_sql(spark, duck, plan, name):
    df = SPARK[name](spark, SF)
    assert compare(df, duck, SQL[name]) in ("", "both empty")
    text = plan(df)
    assert "EvalPython" not in text and "MapIn" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
