"""Cycle detection sends no table through the driver."""

from streamcurate.operators import graph


def test_no_broadcast(spark):
    rows = [(f"n{i}", f"n{(i + 1) % 50}") for i in range(50)] + [("a", "n3"), ("n7", "b"), ("b", "c")]
    found = graph.strongly_connected(spark.createDataFrame(rows, "from string, to string"))
    assert sorted(r.node for r in found.collect()) == sorted(f"n{i}" for i in range(50))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
