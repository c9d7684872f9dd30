"""Boundary cases of the rules, on tables made by hand."""

import pytest
from pyspark.sql import functions as F

from streamcurate.operators import clean as cl
from streamcurate.operators import normalize as nz
from streamcurate.operators import package as pk
from streamcurate.operators import qc, sync
from streamcurate.operators import windows as wn
from streamcurate.specs import GPS, IMU, SpecRegistry

S = 1_000_000


def stream(spark, times, values=None):
    rows = [("s", i + 1, int(t * S), (float(v),)) for i, (t, v) in enumerate(zip(times, values or times, strict=True))]
    return spark.createDataFrame(rows, "session_id string, record_number long, epoch_us long, payload struct<x:double>")


def nearest(spark, target, times, tolerance, bucket=None):
    value, note = sync.nearest("a", tolerance)
    found = sync.neighbours(sync.timeline_reference(stream(spark, [target])), {"a": stream(spark, times)}, bucket)
    return found.select(value["x"].alias("x"), note.alias("n")).first()


@pytest.mark.parametrize("bucket", [None, 100_000])
def test_nearest(spark, bucket):
    assert nearest(spark, 10.0, [9.98, 10.04], S, bucket).x == 9.98
    assert nearest(spark, 10.0, [9.0, 11.0], S, bucket).x == 9.0  # ties go to the earlier
    assert nearest(spark, 10.0, [9.0], S, bucket).n.matched  # inclusive
    assert nearest(spark, 10.0, [9.0], S - 1, bucket).n.reason == "OUTSIDE_TOLERANCE"


def test_nearest_takes_the_last_of_equal_times(spark):
    value, _ = sync.nearest("a", S)
    found = sync.neighbours(sync.timeline_reference(stream(spark, [5.0])), {"a": stream(spark, [5.0, 5.0], [1, 2])})
    assert found.select(value["x"]).first()[0] == 2.0


def test_linear(spark):
    a = stream(spark, [0.0, 10.0], [0.0, 100.0])
    value, note = sync.linear("a", 1, a.schema["payload"].dataType)
    found = sync.neighbours(sync.timeline_reference(stream(spark, [2.5, 10.0, 12.0])), {"a": a})
    got = [(r.v, r.m, r.r) for r in found.orderBy("epoch_us").select(value["x"].alias("v"), note["matched"].alias("m"), note["reason"].alias("r")).collect()]
    assert got == [(25.0, True, None), (100.0, True, None), (None, False, "NO_EXTRAPOLATION")]


def test_clock_rounds_half_to_even(spark):
    moved = sync.clock_correct(stream(spark, [0.0, 1.0]), offset_ms=0.0005).orderBy("record_number").collect()
    assert [r.epoch_us for r in moved] == [0, S]
    with pytest.raises(ValueError):
        sync.clock_correct(stream(spark, [0.0]), drift_ppm=-1e6)


def rows(spark, n):
    return spark.createDataFrame([("s", i, i * S) for i in range(n)], "session_id string, row_index long, epoch_us long")


@pytest.mark.parametrize(("size", "stride", "drop", "want"), [(3, 2, True, {0: 3, 1: 3}), (3, 2, False, {0: 3, 1: 3, 2: 2}), (2, 3, False, {0: 2, 1: 2}), (9, 1, True, {}), (9, 1, False, {0: 6})])
def test_count_windows(spark, size, stride, drop, want):
    got = wn.count_windows(rows(spark, 6), size, stride, drop).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == want


def test_time_windows(spark):
    got = wn.time_windows(rows(spark, 5), 2000, 1000).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {0: 2, 1: 2, 2: 2}


def test_statistics_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "row_index long, v double")
    assert set(df.agg(*(wn.statistic(F.col("v"), s).alias(s) for s in wn.STATISTICS)).first()) == {None}


def test_displacement(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 1.0)], "row_index long, lat double, lon double")
    assert abs(df.agg(wn.displacement_m(F.col("lat"), F.col("lon"))).first()[0] - 111_194.93) < 0.01


def test_sequential_split(spark):
    groups = spark.createDataFrame([(f"g{i}", i, 10) for i in range(4)], "group_id string, position long, n long")
    got = {r.group_id: r.split for r in pk.sequential_split(groups, 0.5, 0.25, 0.25).collect()}
    assert got == {"g0": "train", "g1": "train", "g2": "validation", "g3": "test"}
    got = {r.group_id: r.split for r in pk.sequential_split(groups, 0.75, 0.0, 0.25).collect()}
    assert got == {"g0": "train", "g1": "train", "g2": "train", "g3": "test"}  # an empty ratio is skipped


def test_overlap_groups_chain(spark):
    df = spark.createDataFrame([("s", "a", 0, 19), ("s", "b", 10, 29), ("s", "c", 25, 44), ("s", "d", 45, 50)], "session_id string, sample_id string, source_row_start long, source_row_end long")
    got = {r.sample_id: r.group_id for r in pk.overlap_groups(df).collect()}
    assert got["a"] == got["b"] == got["c"] != got["d"]


def test_leakage_is_found(spark):
    df = spark.createDataFrame([("s", "a", "g", "train", 0, 9), ("s", "b", "h", "test", 5, 14)], "session_id string, sample_id string, group_id string, split string, source_row_start long, source_row_end long")
    found = pk.leakage_audit(df).first()
    assert (found.chains_in_several_splits, found.passed) == (1, False)


def test_drift(spark):
    shape = "path string, mean double, std double, present long"
    base = spark.createDataFrame([("a", 1.0, 1.0, 5), ("b", 1.0, 0.0, 5), ("c", 1.0, 1.0, 5)], shape)
    now = spark.createDataFrame([("a", 3.0, 1.0, 5), ("b", 2.0, 1.0, 5), ("d", None, None, 0), ("e", 1.0, 1.0, 5)], shape)
    got = {r.path: (r.compared, r.score, r.reason) for r in qc.drift(now, base).collect()}
    assert got == {"a": (True, 2.0, None), "b": (True, None, "baseline_std_zero_mean_shifted"), "d": (False, None, "missing_in_current"), "e": (False, None, "missing_in_baseline")}


def test_dedup_needs_equal_payloads(spark):
    df = spark.createDataFrame([("s", 0, 1, (1.0,)), ("s", 1, 1, (1.0,)), ("s", 2, 1, (None,))], "session_id string, row_index long, epoch_us long, streams struct<x:double>")
    got = {r.row_index: r.duplicate_of_row_index for r in cl.dedup_exact(df).collect()}
    assert got == {0: None, 1: 0, 2: None}
    with pytest.raises(ValueError):
        cl.redact(df, ["a..b"])


def test_normalization_refuses(spark):
    with pytest.raises(ValueError):
        nz.resolve_aliases(spark.createDataFrame([("1", "2")], "ax string, acc_x string"), IMU)
    with pytest.raises(ValueError):
        nz.unit_factors(IMU, {"acceleration": "g"})
    with pytest.raises(ValueError):
        SpecRegistry(GPS, GPS)
    bad = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", "1", "x", "1")], "record_number long, timestamp string, accel_x string, accel_y string, accel_z string")
    with pytest.raises(Exception, match="bad accel_y"):
        nz.normalize(bad, IMU, {"acceleration": "g", "angular_velocity": "rad/s"}).collect()


def test_package_gate_and_commit(spark, tmp_path):
    samples = spark.range(200).selectExpr("'s' AS session_id", "cast(id AS string) AS sample_id", "id * 10 AS source_row_start", "id * 10 + 5 AS source_row_end", "id AS k")
    reports = spark.createDataFrame([("q1", "t", "a", "passed"), ("q2", "other", "a", "passed"), ("q3", "t", "b", "passed"), ("q4", "t", "a", "failed")], "qc_id string, transformation_id string, sha256 string, status string")
    ask = lambda qc: {"qc_id": qc, "transformation_id": "t", "sha256": "a"}
    for qc, code in (("q2", "QC_TRANSFORMATION_MISMATCH"), ("q3", "ARTIFACT_CHECKSUM_MISMATCH"), ("q4", "QC_NOT_ACCEPTED"), ("q9", "QC_NOT_FOUND"), (None, "QC_NOT_FOUND")):
        with pytest.raises(ValueError, match=code):
            pk.package(samples, reports=reports, request=ask(qc))
    made = pk.package(samples, reports=reports, request=ask("q1"))
    path = str(tmp_path / "package")
    with pytest.raises(ValueError, match="PACKAGE_NOT_COMMITTED"):
        pk.committed(spark, path)
    pk.commit(made, path)
    status, index = pk.committed(spark, path)
    assert status.first().status == "completed" and index.count() == 200 and status.first().audit.passed
    one = pk.package(samples, grouping="session")
    pk.commit(one, path + "2")
    with pytest.raises(ValueError, match="PACKAGE_REJECTED: INSUFFICIENT_GROUPS_FOR_SPLIT, EMPTY_REQUESTED_SPLIT"):
        pk.committed(spark, path + "2")
