"""Every registered query against its check SQL, and the shape of its plan."""

import pytest
from compare import SF, difference

from __spark_entry__ import entry
from loamframe.plans import CHECKS, QUERIES

STREAMS = {"S1_stream_ingest", "S2_stream_period", "S3_stream_upsert"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_check(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name not in STREAMS:
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "EvalPython" not in plan
    assert difference(df, duck, CHECKS[name]) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    assert entry(spark).count() > 0
