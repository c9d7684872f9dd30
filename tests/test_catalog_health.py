"""G16 by one grouping of names."""

from streamcurate.operators import lineage as ln


def test_each_problem_once_and_one_exchange(spark):
    artifacts = spark.createDataFrame([("ingestion", "1"), ("integrity", "2"), ("package", "3"), ("package", "4")], "artifact_type string, artifact_id string")
    edges = spark.createDataFrame([("ingestion", "1", "integrity", "2"), ("integrity", "9", "package", "3"), ("integrity", "9", "package", "5")], "parent_type string, parent_id string, child_type string, child_id string")
    events = spark.createDataFrame([("integrity", "8"), ("integrity", "8"), ("integrity", "2")], "artifact_type string, artifact_id string")
    versions = spark.createDataFrame([("3",), ("7",), ("7",)], "package_id string")
    found = ln.catalog_health(artifacts, edges, events, versions)
    assert sorted(map(tuple, found.collect())) == [("dangling_governance", "integrity/8"), ("dangling_version", "package/7"), ("missing_parent", "integrity/9"), ("orphan", "package/4")]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan and plan.count("Exchange ") == 1
