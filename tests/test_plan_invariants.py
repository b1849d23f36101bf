"""Plan invariants over every batch query key: no cross or nested-loop joins,
no Python UDF operators, and column-pruned scans."""

import pytest

import __spark_entry__ as E
from riskweave.plans import registry
from tests.conftest import SF_SMALL

BATCH_KEYS = [k for k in registry.QUERIES if not k.startswith("stream_")]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_plan_invariants(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"
    # column pruning: the events table has 6 columns and no key needs event_type
    scans = [line for line in plan.splitlines() if "FileScan" in line and "events.parquet" in line]
    assert all("event_type" not in line for line in scans), key


def test_high_risk_users_aggregates_before_join(spark):
    df = E.queries()["high_risk_users"](spark, SF_SMALL)
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = opt.index("Join LeftOuter")
    assert "Aggregate [user_id" in opt[join_at:]  # the flagged side is aggregated below the join
