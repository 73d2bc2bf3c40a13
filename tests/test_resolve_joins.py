"""Resolution over rows whose number the planner guesses far too low."""

from braidwork.operators import resolve as R
from braidwork.plans import record_queries as D


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_join_is_a_broadcast(spark, sf):
    rows, odd = R.resolve(*D._cascade(spark, sf))
    for df in (rows, odd, R.witness_methods(rows), R.stream_rows(rows, "failed")):
        assert "Broadcast" not in plan(df)
    assert "Broadcast" not in plan(D.q_resource_links(spark, sf))
