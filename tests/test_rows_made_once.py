"""Invariants read the resolved rows from a table instead of resolving once for each rule."""

from braidwork.plans import record_queries as D


def test_invariants_resolve_once(spark, sf):
    plan = D.q_invariants(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "records-" in D.q_invariants(spark, sf)._jdf.queryExecution().executedPlan().toString()
