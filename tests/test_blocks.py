"""Long sequences in blocks, and what must fail or be refused."""

import random

import pytest
from pyspark.sql import functions as F

from streamcurate.functions import ranking
from streamcurate.operators import lineage as ln
from streamcurate.operators import package as pk
from streamcurate.operators import qc, sync
from streamcurate.operators import windows as wn

RANGES = "session_id string, sample_id string, source_row_start long, source_row_end long"


def sequence(spark, n=60):
    rng = random.Random(3)
    rows = [("s0" if i % 2 else None, i * 3, rng.choice([None, i, i - 5])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "session_id string, at long, v long").repartition(4)


@pytest.mark.parametrize("size", [1, 10, 100_000])
def test_blocks(spark, size):
    rows, df = sequence(spark)
    want, last, count = [], {}, {}
    for s, at, v in rows:
        want.append((s, at, last.get(s), count.get(s, 0)))
        last[s] = v if v is not None else last.get(s)
        count[s] = count.get(s, 0) + 1
    before = {(r.session_id, r.at): r.p for r in ranking.last_before(df, ["session_id"], "at", "v", "p", size).collect()}
    number = {(r.session_id, r.at): (r.i, r.n) for r in ranking.numbered(df, ["session_id"], "at", size).collect()}
    assert before == {(s, at): p for s, at, p, _ in want}
    assert number == {(s, at): (i, 30) for s, at, _, i in want}
    assert [r.position for r in ranking.positions(df, "at").orderBy("at").collect()] == list(range(60))


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_overlap_groups_in_blocks(spark, block):
    rng = random.Random(block)
    rows = [(f"s{i % 2}", str(i), (a := rng.randint(0, 400)), a + rng.choice([0, 3, 30])) for i in range(60)]
    got = {r.sample_id: r.group_id for r in pk.overlap_groups(spark.createDataFrame(rows, RANGES), block=block).collect()}
    chains, end, session = [], -1, None
    for s, i, a, b in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        if s != session or a > end:
            chains.append(set())
            end = -1
        chains[-1].add(i)
        session, end = s, max(end, b)
    assert {frozenset(k for k, g in got.items() if g == x) for x in set(got.values())} == set(map(frozenset, chains))


def test_what_must_fail(spark):
    back = spark.createDataFrame([("s", 1, 5, 1), ("s", 2, 4, 1)], "session_id string, record_number long, epoch_us long, row_index long")
    with pytest.raises(Exception, match="time goes back"):
        sync.assert_monotonic(back).collect()
    with pytest.raises(Exception, match="time goes back"):
        wn.assert_row_order(back.withColumn("row_index", F.col("record_number"))).collect()
    with pytest.raises(Exception, match="MISSING_GROUP_METADATA"):
        pk.overlap_groups(spark.createDataFrame([("s", "a", None, 3)], RANGES)).collect()
    index = spark.createDataFrame([("s", "a", "g", "train", 0, 9)], "session_id string, sample_id string, group_id string, split string, source_row_start long, source_row_end long")
    with pytest.raises(ValueError, match="SAMPLE_COUNT_MISMATCH"):
        pk.require_audit(pk.leakage_audit(index, index.union(index)))
    with pytest.raises(ValueError, match="LEAKAGE"):
        pk.require_audit(pk.leakage_audit(index.union(index)))
    with pytest.raises(ValueError, match="QC_NOT_ACCEPTED"):
        pk.package(index.drop("group_id", "split"), reports=spark.createDataFrame([("failed",)], "status string"))
    edge = spark.createDataFrame([("x", "1", "x", "2", "r")], "parent_type string, parent_id string, child_type string, child_id string, relationship string")
    with pytest.raises(ValueError, match="unknown parent"):
        ln.missing_parents(edge, spark.createDataFrame([("x", "2")], "artifact_type string, artifact_id string"), strict=True)


def test_both_ways_do_not_turn_round(spark):
    edges = spark.createDataFrame([("x", a, "x", b, "r") for a, b in ("AB", "AC", "BD")], "parent_type string, parent_id string, child_type string, child_id string, relationship string")
    root = spark.createDataFrame([("x/B",)], "root string")
    assert {(r.node, r.depth) for r in ln.traverse(root, edges, "both").collect()} == {("x/B", 0), ("x/A", 1), ("x/D", 1)}
    assert {(r.parent_id, r.child_id) for r in ln.traversed_edges(root, edges).collect()} == {("A", "B"), ("B", "D")}


def test_buckets_follow_the_rows(spark):
    df = spark.range(1000).select(F.lit("s").alias("session_id"), (F.col("id") * 1000).alias("epoch_us"))
    assert sync.bucket_for([df], 5000) is None
    assert sync.bucket_for([df, df], 100) == 999_000 * 100 // 2000


def test_baseline_of_another_profile(spark):
    found = qc.baseline_incompatible(spark, ("a", "1"), ("a", "2")).collect()
    assert [(r.code, r.severity, r.path) for r in found] == [("BASELINE_INCOMPATIBLE", "warning", "a@2")]
    assert not qc.baseline_incompatible(spark, ("a", "1"), ("a", "1")).take(1)


def test_exact_percentiles(spark):
    rng = random.Random(8)
    values = [rng.choice([1.0, 2.5, rng.random() * 9]) for _ in range(101)]
    long = spark.createDataFrame([("p", v) for v in values] + [("p", None), ("q", 4.0)], "path string, value double").repartition(5)
    got = {r.path: r.percentiles for r in qc.feature_percentiles(long).collect()}
    ranked = sorted(values)
    for p, v in zip(qc.PERCENTILES, got["p"], strict=True):
        low = int(p * 100)
        assert abs(v - (ranked[low] + (ranked[min(low + 1, 100)] - ranked[low]) * (p * 100 - low))) < 1e-9
    assert got["q"] == [4.0] * 7
