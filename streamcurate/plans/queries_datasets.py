"""Queries of dataset QC, packaging, lineage and streaming."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import functions as F

from ..functions.storage import fresh_path, materialize
from ..operators import lineage as ln
from ..operators import package as pk
from ..operators import qc
from ..operators import windows as wn
from ..sources import files as fs
from ..specs import GPS, IMU
from ..streaming import live
from .pipeline import PipelineConfig
from .pipeline import run as run_pipeline
from .registry import FEATURES, HOURS_6_US, WINDOWS_SQL, query, rounded, samples, stats_sql, streams, table

COLUMNS = ["l_quantity", "l_discount", "l_tax"]


def holes(spark, d):
    """Line items with planted nulls and values that aren't finite."""
    return table(spark, d, "lineitem").withColumns({"l_tax": F.expr("CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN double('NaN') WHEN l_orderkey % 23 = 0 THEN double('Infinity') ELSE l_tax END")})


def long(spark, d, columns=COLUMNS):
    return qc.long_form(holes(spark, d), columns)


HOLES_SQL = """WITH items AS (SELECT * REPLACE (CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN 'nan'::DOUBLE WHEN l_orderkey % 23 = 0 THEN 'inf'::DOUBLE ELSE l_tax END AS l_tax) FROM lineitem),
long AS (SELECT 'l_quantity' AS path, l_quantity AS value FROM items UNION ALL SELECT 'l_discount', l_discount FROM items UNION ALL SELECT 'l_tax', l_tax FROM items),
good AS (SELECT path, value FROM long WHERE isfinite(value))"""

_LEAVES = [f"features.imu.statistics.{c}_{s}" for c in ("accel_x", "gyro_x", "accel_magnitude") for s in wn.STATISTICS] + [f"features.gps.statistics.altitude_{s}" for s in wn.STATISTICS] + ["features.gps.derived.displacement_m"]
_SAMPLES_SQL = WINDOWS_SQL + f""", s AS (SELECT session_id, k, min(epoch_us) AS start_us, max(epoch_us) AS end_us, count(*) AS row_count, min(row_index) AS source_row_start, max(row_index) AS source_row_end, bool_or(gps_ok) AS gps, avg(gps_ok::INT) AS gps_cov, count(altitude) AS n_alt, 'sample_' || left(sha256('::' || session_id || '/' || k || ':' || min(epoch_us) || ':' || max(epoch_us)), 32) AS sample_id, {stats_sql("accel_x", "accel_x")} FROM w GROUP BY session_id, k)"""


_MAG = "sqrt(accel_x * accel_x + accel_y * accel_y + accel_z * accel_z)"
#: Every numeric leaf of the samples, and the issues that the report finds in them.
_ALL_SQL = (
    WINDOWS_SQL
    + f""", m AS (SELECT *, {_MAG} AS mag FROM w), e AS (SELECT session_id, k, min(epoch_us) AS start_us, count(*) AS row_count, bool_or(gps_ok) AS gps, {stats_sql("accel_x", "accel_x")}, {stats_sql("gyro_x", "gyro_x")}, {stats_sql("mag", "accel_magnitude")}, {stats_sql("altitude", "altitude")},
 CASE WHEN count(latitude) >= 2 THEN sin(radians(arg_max(latitude, row_index) FILTER (latitude IS NOT NULL) - arg_min(latitude, row_index) FILTER (latitude IS NOT NULL))) + arg_max(longitude, row_index) FILTER (longitude IS NOT NULL) END AS displacement_m FROM m GROUP BY session_id, k),
leaf AS ("""
    + " UNION ALL ".join(f"SELECT '{p}' AS path, {p.rsplit('.', 1)[1]} AS value FROM e" for p in _LEAVES)
    + """), prof AS (SELECT path, count(*) AS total, count(value) AS present, var_pop(value) AS variance, min(value) AS low FROM leaf GROUP BY path),
report AS (SELECT 'FEATURE_RANGE_VIOLATION' AS code, 'error' AS severity FROM prof WHERE path = 'features.imu.statistics.accel_x_mean' AND low < {low}
 UNION ALL SELECT 'LOW_MODALITY_COVERAGE', 'error' FROM e HAVING avg(gps::INT) < {coverage}
 UNION ALL SELECT 'LOW_FEATURE_COMPLETENESS', 'warning' FROM prof WHERE 1 - present / total > {missing}
 UNION ALL SELECT 'LOW_FEATURE_VARIANCE', 'warning' FROM prof WHERE present >= 2 AND variance < 1e-12
 UNION ALL SELECT 'GROUP_IMBALANCE', 'warning' FROM (SELECT session_id FROM e GROUP BY session_id HAVING count(*) > {share} * (SELECT count(*) FROM e)) WHERE (SELECT count(DISTINCT session_id) FROM e) >= 2
 UNION ALL SELECT 'NON_MONOTONIC_SAMPLE_TIME', 'warning' FROM (SELECT start_us, lag(start_us) OVER (PARTITION BY session_id ORDER BY k) AS p FROM e) WHERE start_us < p)"""
)


def _report_sql(low, coverage, missing, share):
    out = _ALL_SQL
    for name, value in (("low", low), ("coverage", coverage), ("missing", missing), ("share", share)):
        out = out.replace("{" + name + "}", str(value))
    return out


@query("q1_scalar_features", _SAMPLES_SQL + ", paths AS (SELECT unnest(" + repr(_LEAVES) + ") AS path) SELECT path, (SELECT count(*) FROM s) AS total, CASE WHEN path LIKE '%displacement%' THEN (SELECT count(*) FROM s WHERE n_alt >= 2) WHEN path LIKE '%altitude%' THEN (SELECT count(*) FROM s WHERE n_alt > 0) ELSE (SELECT count(*) FROM s) END AS present FROM paths")
def q1(spark, d):
    return qc.scalar_features(samples(spark, d)).groupBy("path").agg(F.count("*").alias("total"), F.count("value").alias("present"))


@query("q2_feature_counts", HOLES_SQL + " SELECT path, count(*) AS total, count(*) FILTER (isfinite(value)) AS present, count(*) FILTER (value IS NULL) AS nulls, count(*) FILTER (NOT isfinite(value)) AS non_finite FROM long GROUP BY path")
def q2(spark, d):
    return qc.feature_profile(long(spark, d)).select("path", "total", "present", "nulls", "non_finite")


@query("q3_feature_moments", HOLES_SQL + " SELECT path, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max FROM good GROUP BY path")
def q3(spark, d):
    return rounded(qc.feature_profile(long(spark, d)).select("path", "mean", "variance", "std", "min", "max"))


@query("q4_feature_percentiles", HOLES_SQL + ", p AS (SELECT path, quantile_cont(value, [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]) AS q FROM good GROUP BY path) SELECT path, round(q[1], 6) AS p01, round(q[3], 6) AS p25, round(q[4], 6) AS p50, round(q[7], 6) AS p99 FROM p")
def q4(spark, d):
    p = qc.feature_percentiles(long(spark, d))
    return p.select("path", *(F.round(F.col("percentiles")[i], 6).alias(n) for i, n in ((0, "p01"), (2, "p25"), (3, "p50"), (6, "p99"))))


@query("q5_modality_summary", _SAMPLES_SQL + " SELECT 'gps' AS stream, count(*) FILTER (gps) AS samples_present, round(avg(gps::INT), 6) AS present_ratio, round(avg(gps_cov), 6) AS mean_coverage, round(median(gps_cov), 6) AS median_coverage, min(gps_cov) AS min_coverage, max(gps_cov) AS max_coverage FROM s")
def q5(spark, d):
    return rounded(qc.modality_summary(samples(spark, d)).where("stream = 'gps'"))


@query("q6_temporal_extent", _SAMPLES_SQL + " SELECT min(start_us) AS earliest_us, max(end_us) AS latest_us, round((max(end_us) - min(start_us)) / 1e6, 6) AS duration_s FROM s")
def q6(spark, d):
    return rounded(qc.temporal_extent(samples(spark, d)))


@query("q7_window_size_summary", "SELECT min(n) AS min_rows, max(n) AS max_rows, round(avg(n), 6) AS mean_rows, round(stddev_pop(n), 6) AS std_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def q7(spark, d):
    return rounded(qc.window_size_summary(table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("row_count"))))


@query("q8_check_dataset_size", "SELECT 'DATASET_TOO_SMALL' AS code, count(*)::DOUBLE AS observed, 1e12::DOUBLE AS threshold FROM lineitem")
def q8(spark, d):
    return qc.check_dataset_size(table(spark, d, "lineitem"), 10**12).select("code", "observed", "threshold")


@query("q9_check_modality_coverage", _SAMPLES_SQL + " SELECT 'gps' AS path, round(avg(gps::INT), 6) AS observed, 1.0::DOUBLE AS threshold FROM s HAVING avg(gps::INT) < 1 UNION ALL SELECT 'lidar', 0.0, 0.5")
def q9(spark, d):
    found = qc.check_modality_coverage(qc.modality_summary(samples(spark, d)), {"gps": 1.0, "lidar": 0.5, "imu": 1.0})
    return rounded(found.select("path", "observed", "threshold"))


@query("q10_check_completeness", HOLES_SQL + " SELECT path, round(1 - count(*) FILTER (isfinite(value)) / count(*), 6) AS observed, 'error' AS severity FROM long GROUP BY path HAVING path = 'l_tax'")
def q10(spark, d):
    found = qc.check_completeness(qc.feature_profile(long(spark, d)), 0.5, {"l_tax": (0.01, "error")})
    return rounded(found.select("path", "observed", "severity"))


@query("q11_check_variance", "SELECT 'one' AS path, 0.0::DOUBLE AS observed FROM lineitem HAVING count(*) >= 2")
def q11(spark, d):
    df = table(spark, d, "lineitem").select(F.lit(1.0).alias("one"), "l_tax")
    return qc.check_variance(qc.feature_profile(qc.long_form(df, ["one", "l_tax"]))).select("path", "observed")


@query("q12_check_range", HOLES_SQL + " SELECT path, min(value) AS observed, 2.0::DOUBLE AS threshold FROM good WHERE path = 'l_quantity' GROUP BY path UNION ALL SELECT path, max(value), 0.05 FROM good WHERE path = 'l_discount' GROUP BY path")
def q12(spark, d):
    return qc.check_range(qc.feature_profile(long(spark, d)), {"l_quantity": (2.0, 3.0), "l_discount": (None, 0.05), "l_tax": (0.0, 1.0)}).select("path", "observed", "threshold")


@query("q13_check_non_finite", HOLES_SQL + " SELECT path, count(*)::DOUBLE AS observed FROM long WHERE NOT isfinite(value) GROUP BY path")
def q13(spark, d):
    return qc.check_non_finite(qc.feature_profile(long(spark, d))).select("path", "observed")


@query("q14_duplicate_sample_id", 'SELECT sample_id, "index", first_index FROM (SELECT o_custkey::VARCHAR AS sample_id, o_orderkey AS "index", min(o_orderkey) OVER (PARTITION BY o_custkey) AS first_index FROM orders) WHERE "index" > first_index')
def q14(spark, d):
    return qc.duplicate_sample_ids(table(spark, d, "orders").selectExpr("CAST(o_custkey AS STRING) AS sample_id", "o_orderkey AS k"))


@query("q15_sample_time_order", "SELECT o_custkey AS session_id, o_orderkey AS k FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders) WHERE o_orderdate < p")
def q15(spark, d):
    df = table(spark, d, "orders").selectExpr("o_custkey AS session_id", "o_orderkey AS k", "unix_micros(CAST(o_orderdate AS TIMESTAMP)) AS start_us")
    return qc.sample_time_order(df).select("session_id", "k")


@query("q16_group_imbalance", "SELECT quality, count(*) AS n, round(count(*) / (SELECT count(*) FROM labels), 6) AS fraction FROM labels GROUP BY quality HAVING count(*) / (SELECT count(*) FROM labels) > 0.5")
def q16(spark, d):
    return rounded(qc.group_imbalance(table(spark, d, "labels"), "quality", 0.5))


@query("q17_drift", "WITH a AS (SELECT avg(l_quantity) AS m, avg(l_tax) AS t FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s, avg(l_tax) AS t, stddev_pop(l_tax) AS u FROM lineitem WHERE l_returnflag = 'R') SELECT 'l_quantity' AS path, TRUE AS compared, round((a.m - b.m) / s, 6) AS score, abs((a.m - b.m) / s) > 0.01 AS drifted FROM a, b UNION ALL SELECT 'l_tax', TRUE, round((a.t - b.t) / u, 6), abs((a.t - b.t) / u) > 0.01 FROM a, b")
def q17(spark, d):
    items = table(spark, d, "lineitem")
    side = lambda f: qc.feature_profile(qc.long_form(items.where(F.col("l_returnflag") == f), ["l_quantity", "l_tax"]))
    return rounded(qc.drift(side("A"), side("R"), 0.01).select("path", "compared", "score", "drifted"))


@query("q18_qc_report", _report_sql(20, 1, 0.3, 0.008) + " SELECT code, severity, count(*) AS n FROM report GROUP BY ALL")
def q18(spark, d):
    found, _ = qc.qc_report(materialize(samples(spark, d), "samples"), 1, {"gps": 1.0}, 0.3, {"features.imu.statistics.accel_x_mean": (20.0, None)}, 0.008)
    return found.groupBy("code", "severity").agg(F.count("*").alias("n"))


@query("q18_qc_status", _report_sql(20, 1, 0.3, 0.008) + " SELECT count(*) AS issue_count, count(*) FILTER (severity = 'error') AS error_count, count(*) FILTER (severity = 'warning') AS warning_count, count(*) > 3 AS issues_truncated, CASE WHEN count(*) FILTER (severity = 'error') > 0 THEN 'failed' WHEN count(*) > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS status FROM report")
def q18_status(spark, d):
    return qc.qc_report(materialize(samples(spark, d), "samples"), 1, {"gps": 1.0}, 0.3, {"features.imu.statistics.accel_x_mean": (20.0, None)}, 0.008, most=3)[1]


@query("p1_sample_identity", "SELECT o_custkey::VARCHAR AS sample_id, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def p1(spark, d):
    return pk.check_sample_identity(table(spark, d, "orders").selectExpr("CAST(o_custkey AS STRING) AS sample_id"))


def ranges(spark, d):
    return table(spark, d, "orders").selectExpr("o_custkey % 50 AS session_id", "CAST(o_orderkey AS STRING) AS sample_id", "o_orderkey AS source_row_start", "o_orderkey + o_custkey % 90 AS source_row_end", "o_orderkey AS k")


_RANGES = "WITH r AS (SELECT o_custkey % 50 AS session_id, o_orderkey::VARCHAR AS sample_id, o_orderkey AS a, o_orderkey + o_custkey % 90 AS b FROM orders), f AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY session_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT FALSE THEN 1 ELSE 0 END AS fresh FROM r), g AS (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY a, b) AS island FROM f), named AS (SELECT *, 'grp_' || left(sha256(':' || session_id || ':' || min(a) OVER (PARTITION BY session_id, island) || ':' || max(b) OVER (PARTITION BY session_id, island)), 16) AS group_id FROM g)"


@query("p2_group_source_overlap", _RANGES + " SELECT session_id, sample_id, group_id FROM named")
def p2(spark, d):
    return pk.overlap_groups(ranges(spark, d)).select("session_id", "sample_id", "group_id")


@query("p3_group_session", "SELECT o_orderkey::VARCHAR AS sample_id, 'grp_' || left(sha256((o_custkey % 50)::VARCHAR), 16) AS group_id FROM orders")
def p3(spark, d):
    return pk.session_groups(ranges(spark, d)).select("sample_id", "group_id")


def _share(g):
    return f"(('0x' || left(sha256({g} || ':42:default:1.0.0'), 8))::BIGINT / 4294967296.0)"


_SPLIT = f"CASE WHEN {_share('group_id')} < 0.7 THEN 'train' WHEN {_share('group_id')} < 0.85 THEN 'validation' ELSE 'test' END AS split"


@query("p4_split_group_hash", _RANGES + f" SELECT sample_id, {_SPLIT} FROM named")
def p4(spark, d):
    return pk.overlap_groups(ranges(spark, d)).select("sample_id", pk.hash_split(F.col("group_id"), 0.7, 0.15, 0.15).alias("split"))


#: The greedy rule as it reads: a split closes once its count reaches its share, the next starts at 0.
_GREEDY = """WITH RECURSIVE g AS (SELECT c_custkey AS group_id, row_number() OVER (ORDER BY c_custkey) AS i, 1 + c_custkey % 7 AS n FROM customer), t AS (SELECT sum(n) AS total FROM g),
walk(i, s, used) AS (SELECT 0::BIGINT, 0, 0::HUGEINT UNION ALL SELECT g.i, CASE WHEN s < 2 AND used >= CASE s WHEN 0 THEN 0.5 ELSE 0.3 END * total THEN s + 1 ELSE s END, CASE WHEN s < 2 AND used >= CASE s WHEN 0 THEN 0.5 ELSE 0.3 END * total THEN n ELSE used + n END FROM walk JOIN g ON g.i = walk.i + 1, t)
SELECT group_id, ['train', 'validation', 'test'][s + 1] AS split FROM walk JOIN g USING (i)"""


@query("p5_split_sequential", _GREEDY)
def p5(spark, d):
    groups = table(spark, d, "customer").selectExpr("c_custkey AS group_id", "c_custkey AS position", "1 + c_custkey % 7 AS n")
    return pk.sequential_split(groups, 0.5, 0.3, 0.2).select("group_id", "split")


def split_ranges(spark, d):
    grouped = pk.overlap_groups(ranges(spark, d))
    return grouped.withColumn("split", pk.hash_split(F.col("group_id"), 0.7, 0.15, 0.15))


@query("p6_leakage_audit", "SELECT 0 AS duplicate_sample_ids, 0 AS groups_in_several_splits, count(*) AS samples, TRUE AS passed FROM orders")
def p6(spark, d):
    return pk.leakage_audit(split_ranges(spark, d)).select("duplicate_sample_ids", "groups_in_several_splits", "samples", "passed")


@query("p7_split_stats", _RANGES + f", x AS (SELECT *, {_SPLIT} FROM named) SELECT split, count(*) AS samples, count(DISTINCT group_id) AS groups, round(count(*) / (SELECT count(*) FROM x), 6) AS sample_ratio FROM x GROUP BY split")
def p7(spark, d):
    return rounded(pk.split_stats(split_ranges(spark, d)))


@query("p8_package_status", "SELECT 'rejected' AS status, 'INSUFFICIENT_GROUPS_FOR_SPLIT,EMPTY_REQUESTED_SPLIT' AS reasons")
def p8(spark, d):
    one = split_ranges(spark, d).withColumns({"group_id": F.lit("g"), "split": F.lit("train")})
    return pk.package_status(pk.split_stats(one), {"train": 0.8, "validation": 0.1, "test": 0.1}).select("status", F.array_join("reasons", ",").alias("reasons"))


@query("p9_split_index", _RANGES + f" SELECT session_id, sample_id, group_id, {_SPLIT}, a AS source_row_start, b AS source_row_end FROM named")
def p9(spark, d):
    return pk.split_index(split_ranges(spark, d))


@query("p10_qc_gate", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 4 <> 0")
def p10(spark, d):
    orders = table(spark, d, "orders")
    meta = orders.selectExpr("o_orderkey", "o_orderkey AS transformation_id", "'a' AS sha256")
    reports = orders.selectExpr("o_orderkey AS transformation_id", "CASE WHEN o_orderkey % 4 = 0 THEN 'b' ELSE 'a' END AS sha256", "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'passed' ELSE 'passed_with_warnings' END AS status")
    return pk.qc_gate(meta, reports).select("o_orderkey")


_PACKED = _SAMPLES_SQL + f", grouped AS (SELECT session_id, k, sample_id, 'grp_' || left(sha256(session_id), 16) AS group_id FROM s), packed AS (SELECT *, CASE WHEN {_share('group_id')} < 0.8 THEN 'train' WHEN {_share('group_id')} < 0.9 THEN 'validation' ELSE 'test' END AS split FROM grouped)"


@query("p11_package", _PACKED + " SELECT session_id, k, sample_id, group_id, split FROM packed")
def p11(spark, d):
    """What `commit` writes, after QC gate and audit, read back."""
    rows = materialize(samples(spark, d), "samples")
    path = fresh_path(spark, "package")
    reports = spark.createDataFrame([("q", "t", "a", "passed"), ("q2", "other", "b", "failed")], "qc_id string, transformation_id string, sha256 string, status string")
    pk.commit(pk.package(rows, (0.8, 0.1, 0.1), "session", reports=reports, request={"qc_id": "q", "transformation_id": "t", "sha256": "a"}), path, parquet=True)
    lines = spark.read.schema("session_id string, k long, sample_id string, group_id string, split string").json(f"{path}/jsonl")
    return lines.join(spark.read.parquet(f"{path}/index").select("sample_id"), "sample_id", "left_semi").join(spark.read.parquet(f"{path}/parquet").select("sample_id"), "sample_id", "left_semi")


@query("p11_report_refusal", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'QC_NOT_FOUND' WHEN o_orderkey % 7 = 0 THEN 'QC_TRANSFORMATION_MISMATCH' WHEN o_orderkey % 11 = 0 THEN 'ARTIFACT_CHECKSUM_MISMATCH' WHEN o_orderkey % 13 = 0 THEN 'QC_REPORT_CHECKSUM_MISMATCH' WHEN o_orderstatus = 'F' THEN 'QC_NOT_ACCEPTED' END AS refused FROM orders")
def p11_refusal(spark, d):
    orders = table(spark, d, "orders")
    requests = orders.selectExpr("o_orderkey", "concat('qc', o_orderkey) AS qc_id", "o_custkey AS transformation_id", "sha2(o_orderpriority, 256) AS sha256")
    reports = orders.where("o_orderkey % 5 <> 0").selectExpr(
        "concat('qc', o_orderkey) AS qc_id",
        "o_custkey + int(o_orderkey % 7 = 0) AS transformation_id",
        "sha2(concat(o_orderpriority, CASE WHEN o_orderkey % 11 = 0 THEN '!' ELSE '' END), 256) AS sha256",
        "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'passed' ELSE 'passed_with_warnings' END AS status",
        "o_orderstatus AS report_json",
        "sha2(concat(o_orderstatus, CASE WHEN o_orderkey % 13 = 0 THEN '!' ELSE '' END), 256) AS report_sha256",
    )
    return pk.report_refusal(requests, reports).select("o_orderkey", "refused")


def written_status(spark, made, accept):
    path = fresh_path(spark, "package")
    pk.commit(made, path)
    status, index = pk.committed(spark, path, accept)
    per = status.select("status", F.array_join("reasons", ",").alias("reasons"), F.explode("splits").alias("s")).select("status", "reasons", "s.split", "s.samples")
    found = index.groupBy("split").agg(F.count("*").alias("in_index"))
    return per.join(found, "split", "left").select("status", "reasons", "split", "samples", F.coalesce("in_index", F.lit(0)).cast("long").alias("in_index"))


@query("p8_committed_completed", _RANGES + f", x AS (SELECT *, CASE WHEN {_share('group_id')} < 0.8 THEN 'train' WHEN {_share('group_id')} < 0.9 THEN 'validation' ELSE 'test' END AS split FROM named) SELECT 'completed' AS status, '' AS reasons, split, count(*) AS samples, count(*) AS in_index FROM x GROUP BY split")
def p8_completed(spark, d):
    return written_status(spark, pk.package(ranges(spark, d)), ("completed",))


@query("p8_committed_rejected", "SELECT 'rejected' AS status, 'INSUFFICIENT_GROUPS_FOR_SPLIT,EMPTY_REQUESTED_SPLIT' AS reasons, s.split, CASE WHEN s.split = t.split THEN n ELSE 0 END AS samples, CASE WHEN s.split = t.split THEN n ELSE 0 END AS in_index FROM (SELECT unnest(['train', 'validation', 'test']) AS split) s, (SELECT count(*) AS n FROM orders) o, " + f"(SELECT CASE WHEN {_share('g')} < 0.8 THEN 'train' WHEN {_share('g')} < 0.9 THEN 'validation' ELSE 'test' END AS split FROM (SELECT 'grp_' || left(sha256('one'), 16) AS g)) t")
def p8_rejected(spark, d):
    """All samples of one session are one group, which can't fill three splits; the package is written and says so."""
    made = pk.package(ranges(spark, d).withColumn("session_id", F.lit("one")), grouping="session")
    return written_status(spark, made, ("completed", "rejected"))


_BY_CONTENT = _RANGES + ", c AS (SELECT *, sha256((session_id // 10)::VARCHAR || session_id) AS content, min(a) OVER (PARTITION BY session_id, island) AS lo, max(b) OVER (PARTITION BY session_id, island) AS hi FROM g)"


@query("p2_content_groups", _BY_CONTENT + " SELECT sample_id, 'grp_' || left(sha256(content || ':' || lo || ':' || hi), 16) AS group_id, 'grp_' || left(sha256(content || ':session:' || session_id), 16) AS session_group FROM c")
def p2_content(spark, d):
    rows = ranges(spark, d).withColumn("content", F.sha2(F.concat(F.floor(F.col("session_id") / 10).cast("string"), F.col("session_id").cast("string")), 256))
    grouped = pk.overlap_groups(rows, content="content")
    sessions = pk.session_groups(grouped.select("sample_id", "session_id", "content"), "content").select("sample_id", F.col("group_id").alias("session_group"))
    return grouped.select("sample_id", "group_id").join(sessions, "sample_id")


@query("p11_package_sequential", """WITH r AS (SELECT session_id, sample_id, a, b, group_id FROM (NAMED)), f AS (SELECT group_id, min((session_id, a, sample_id)) AS f, count(*) AS n FROM r GROUP BY 1),
o AS (SELECT group_id, n, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, (SELECT sum(n) FROM f) AS total FROM f), c AS (SELECT min(before) FILTER (before >= 0.8 * total) AS cut FROM o)
SELECT sample_id, CASE WHEN before < coalesce(cut, total) THEN 'train' ELSE 'test' END AS split FROM r JOIN o USING (group_id), c""".replace("NAMED", _RANGES + " SELECT * FROM named"))
def p11_sequential(spark, d):
    return pk.package(ranges(spark, d), (0.8, 0.0, 0.2), strategy="sequential").samples.select("sample_id", "split")


def written(spark, d, write, read):
    path = fresh_path(spark, "splits")
    write(split_ranges(spark, d).withColumns({"start_us": F.col("source_row_start"), "end_us": F.col("source_row_end")}), path)
    return read(path)


@query("i8_write_splits_jsonl", _RANGES + f" SELECT sample_id, {_SPLIT} FROM named")
def i8(spark, d):
    return written(spark, d, fs.write_splits_jsonl, lambda p: spark.read.schema("sample_id string, split string").json(p)).select("sample_id", "split")


@query("i9_write_splits_parquet", _RANGES + f" SELECT sample_id, a AS window_index, {_SPLIT} FROM named")
def i9(spark, d):
    return written(spark, d, fs.write_splits_parquet, spark.read.parquet).select("sample_id", "window_index", "split")


# Lineage: regions, nations, customers and orders stand for four stages, each row's parent in the one before.
def artifacts(spark, d):
    parts = []
    for kind, name, key, parent, up in (("ingestion", "region", "r_regionkey", None, None), ("validation", "nation", "n_nationkey", "ingestion", "n_regionkey"), ("integrity", "customer", "c_custkey", "validation", "c_nationkey"), ("package", "orders", "o_orderkey", "integrity", "o_custkey")):
        own = F.array(F.struct(F.lit(parent).alias("type"), F.col(up).cast("string").alias("id"))) if up else F.expr("cast(array() as array<struct<type:string,id:string>>)")
        parts.append(table(spark, d, name).select(F.lit(kind).alias("artifact_type"), F.col(key).cast("string").alias("artifact_id"), own.alias("parents"), F.sha2(F.col(key).cast("string"), 256).alias("content_sha256"), (F.col(key) % 9).cast("string").alias("session_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def edges(spark, d):
    return ln.derive_edges(artifacts(spark, d))


ART_SQL = """WITH RECURSIVE art AS (SELECT 'ingestion' AS artifact_type, r_regionkey::VARCHAR AS artifact_id, NULL AS pt, NULL AS pid, r_regionkey % 9 AS s FROM region UNION ALL SELECT 'validation', n_nationkey::VARCHAR, 'ingestion', n_regionkey::VARCHAR, n_nationkey % 9 FROM nation
 UNION ALL SELECT 'integrity', c_custkey::VARCHAR, 'validation', c_nationkey::VARCHAR, c_custkey % 9 FROM customer UNION ALL SELECT 'package', o_orderkey::VARCHAR, 'integrity', o_custkey::VARCHAR, o_orderkey % 9 FROM orders),
node AS (SELECT artifact_type || '/' || artifact_id AS name, pt || '/' || pid AS parent FROM art),
down(root, node, depth) AS (SELECT name, name, 0 FROM node WHERE name LIKE '{roots}' UNION ALL SELECT down.root, node.name, depth + 1 FROM down JOIN node ON node.parent = down.node),
up(root, node, depth) AS (SELECT name, name, 0 FROM node UNION ALL SELECT up.root, node.parent, depth + 1 FROM up JOIN node ON node.name = up.node WHERE node.parent IS NOT NULL),
ev AS (SELECT event_id, 'integrity' AS t, user_id::VARCHAR AS id, ['active', 'deprecated', 'invalid'][event_id % 3 + 1] AS new_state, CASE WHEN event_id % 11 = 0 THEN ' ' ELSE 'r' END AS reason FROM events),
state AS (SELECT t || '/' || id AS name, arg_max(new_state, event_id) AS state FROM ev WHERE trim(reason) <> '' GROUP BY 1),
ver AS (SELECT DISTINCT 'ds' || o_custkey % 20 AS dataset_name, (o_orderkey % 3) || '.' || (o_orderkey % 7) || '.' || (o_orderkey % 11) AS version, o_orderkey::VARCHAR AS package_id FROM orders),
vev AS (SELECT 'ds' || event_id % 20 AS dataset_name, (event_id % 3) || '.' || (event_id % 7) || '.' || (event_id % 11) AS version, ['deprecated', 'invalid'][event_id % 2 + 1] AS new_state, event_id FROM events WHERE event_type = 'purchase'),
chain AS (SELECT root, node, depth, coalesce(state, 'active') AS state FROM up LEFT JOIN state ON name = node)"""
REGION_SQL, CUSTOMER_SQL = ART_SQL.format(roots="ingestion/%"), ART_SQL.format(roots="integrity/%")


def roots(spark, d, kind):
    return artifacts(spark, d).where(F.col("artifact_type") == kind).select(ln.node("artifact_type", "artifact_id").alias("root"))


def governance(spark, d):
    return table(spark, d, "events").selectExpr("event_id", "'integrity' AS artifact_type", "CAST(user_id AS STRING) AS artifact_id", "element_at(array('active', 'deprecated', 'invalid'), CAST(event_id % 3 + 1 AS INT)) AS new_state", "CASE WHEN event_id % 11 = 0 THEN ' ' ELSE 'r' END AS reason")


def versions(spark, d):
    return table(spark, d, "orders").selectExpr("concat('ds', o_custkey % 20) AS dataset_name", "concat(o_orderkey % 3, '.', o_orderkey % 7, '.', o_orderkey % 11) AS version", "CAST(o_orderkey AS STRING) AS package_id").distinct()


def version_events(spark, d):
    return table(spark, d, "events").where("event_type = 'purchase'").selectExpr("concat('ds', event_id % 20) AS dataset_name", "concat(event_id % 3, '.', event_id % 7, '.', event_id % 11) AS version", "element_at(array('deprecated', 'invalid'), CAST(event_id % 2 + 1 AS INT)) AS new_state", "event_id")


def manifests(spark, d):
    """A manifest of each of the nine kinds for every order, in the fields that such manifests have."""
    orders = table(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS k", "CAST(o_custkey AS STRING) AS c", "o_orderkey % 6 = 5 AS staged", "o_orderstatus AS status")
    session = "named_struct('session_ids', array(c)) AS upstream"
    fields = {
        "ingestion": ["k AS ingestion_id", "c AS session_id", "sha2(k, 256) AS sha256", "'a' AS storage_uri", "'t0' AS ingested_at"],
        "validation": ["k AS validation_id", "k AS ingestion_id", "status", "'t1' AS validated_at"],
        "integrity": ["k AS integrity_id", "k AS validation_id", "status", "'t2' AS created_at"],
        "normalization": ["k AS normalization_id", "k AS integrity_id", "sha2(k, 256) AS normalized_sha256"],
        "synchronization": ["k AS synchronization_id", "sha2(k, 256) AS synchronized_sha256", "array(named_struct('normalization_id', k, 'session_id', c), named_struct('normalization_id', concat('x', c), 'session_id', c)) AS streams"],
        "cleaning": ["k AS cleaning_id", "k AS synchronization_id", "status", "sha2(k, 256) AS cleaned_sha256", "array(named_struct('session_id', c)) AS streams"],
        "transformation": ["k AS transformation_id", "k AS cleaning_id", "sha2(k, 256) AS transformed_sha256", session],
        "qc": ["k AS qc_id", "k AS transformation_id", "status", session],
        "package": ["k AS package_id", "k AS transformation_id", "k AS qc_id", "status", "named_struct('session_ids', array(c, k)) AS upstream"],
    }

    def path(kind):
        return F.when(F.col("staged"), f"/{kind}/.tmp-1/manifest.json").otherwise(F.concat(F.lit(f"/{kind}/"), "k", F.lit("/manifest.json")))

    return {kind: orders.select(path(kind).alias("path"), F.to_json(F.struct(*map(F.expr, items))).alias("value")) for kind, items in fields.items()}


_KINDS = list(ln.STAGES)
_SHA = [k for k in _KINDS if k in ln.CONTENT]
_G1 = f"WITH o AS (SELECT o_orderkey::VARCHAR AS k, o_custkey::VARCHAR AS c, o_orderstatus AS status FROM orders WHERE o_orderkey % 6 <> 5), kinds AS (SELECT unnest({_KINDS}) AS kind, unnest(range(1, 10)) AS stage)"


@query("g1_scan_artifacts", _G1 + f" SELECT kind AS artifact_type, k AS artifact_id, stage AS pipeline_stage, CASE WHEN kind IN {tuple(_SHA)} THEN sha256(k) END AS content_sha256, CASE WHEN kind IN {ln.WITH_STATUS} THEN status END AS status, CASE WHEN kind IN ('ingestion', 'synchronization', 'cleaning', 'transformation', 'qc') THEN c END AS session_id FROM o, kinds")
def g1(spark, d):
    return ln.scan_artifacts(manifests(spark, d)).select("artifact_type", "artifact_id", "pipeline_stage", "content_sha256", "status", "session_id")


@query("g2_derive_edges", _G1 + f", rel AS (SELECT unnest({[a for a, _ in ln.RELATIONSHIPS]}) AS parent_type, unnest({[b for _, b in ln.RELATIONSHIPS]}) AS child_type, unnest({list(ln.RELATIONSHIPS.values())}) AS relationship) SELECT parent_type, k AS parent_id, child_type, k AS child_id, relationship FROM o, rel UNION ALL SELECT 'normalization', 'x' || c, 'synchronization', k, 'synchronized_from' FROM o")
def g2(spark, d):
    return ln.derive_edges(ln.scan_artifacts(manifests(spark, d)))


@query("g3_missing_parents", "SELECT o_custkey::VARCHAR AS parent_id, o_orderkey::VARCHAR AS child_id FROM orders WHERE o_custkey % 10 = 0")
def g3(spark, d):
    known = artifacts(spark, d).where("NOT (artifact_type = 'integrity' AND CAST(artifact_id AS BIGINT) % 10 = 0)")
    return ln.missing_parents(edges(spark, d), known).select("parent_id", "child_id")


@query("g4_traverse_down", REGION_SQL + " SELECT root, node, depth FROM down")
def g4(spark, d):
    return ln.traverse(roots(spark, d, "ingestion"), edges(spark, d), "down")


@query("g4_traverse_up", REGION_SQL + " SELECT root, node, depth FROM up WHERE root LIKE 'package/%'")
def g4_up(spark, d):
    return ln.traverse(roots(spark, d, "package"), edges(spark, d), "up")


#: A free-form graph of customers in twenties: a chain of each twenty, and a side branch from its middle.
_CHAIN = """WITH RECURSIVE edge AS (SELECT 'x/' || c_custkey AS parent, 'x/' || (c_custkey + 1) AS child FROM customer WHERE c_custkey % 20 <> 19 UNION ALL SELECT 'x/' || c_custkey, 'y/' || c_custkey FROM customer WHERE c_custkey % 20 = 7),
root AS (SELECT 'x/' || c_custkey AS root FROM customer WHERE c_custkey % 20 = 10),
down(root, node, depth) AS (SELECT root, root, 0 FROM root UNION ALL SELECT down.root, child, depth + 1 FROM down JOIN edge ON parent = node),
up(root, node, depth) AS (SELECT root, root, 0 FROM root UNION ALL SELECT up.root, parent, depth + 1 FROM up JOIN edge ON child = node)"""


def chains(spark, d):
    customers = table(spark, d, "customer")
    main = customers.where("c_custkey % 20 <> 19").selectExpr("'x' AS parent_type", "CAST(c_custkey AS STRING) AS parent_id", "'x' AS child_type", "CAST(c_custkey + 1 AS STRING) AS child_id")
    side = customers.where("c_custkey % 20 = 7").selectExpr("'x' AS parent_type", "CAST(c_custkey AS STRING) AS parent_id", "'y' AS child_type", "CAST(c_custkey AS STRING) AS child_id")
    roots = customers.where("c_custkey % 20 = 10").selectExpr("concat('x/', c_custkey) AS root")
    return roots, main.unionByName(side)


@query("g4_traverse_both", _CHAIN + " SELECT root, node, min(depth) AS depth FROM (SELECT * FROM up UNION ALL SELECT * FROM down) GROUP BY ALL")
def g4_both(spark, d):
    return ln.traverse(*chains(spark, d), "both")


@query("g4_traversed_edges", _CHAIN + " SELECT root, parent, child FROM up JOIN edge ON child = node UNION SELECT root, parent, child FROM down JOIN edge ON parent = node")
def g4_edges(spark, d):
    found = ln.traversed_edges(*chains(spark, d))
    return found.select("root", ln.node("parent_type", "parent_id").alias("parent"), ln.node("child_type", "child_id").alias("child"))


@query("g4_stage_order", REGION_SQL + " SELECT root, node, array_position(" + repr(list(ln.STAGES)) + ", split_part(node, '/', 1)) AS pipeline_stage FROM up WHERE root LIKE 'package/%'")
def g4_order(spark, d):
    return ln.in_stage_order(ln.traverse(roots(spark, d, "package"), edges(spark, d), "up")).select("root", "node", "pipeline_stage")


@query("g5_detect_cycles", "SELECT 'x/' || c_custkey AS node FROM customer WHERE c_custkey % 24 < 12 AND (c_custkey - c_custkey % 12) + 11 <= (SELECT max(c_custkey) FROM customer) AND c_custkey - c_custkey % 12 >= (SELECT min(c_custkey) FROM customer)")
def g5(spark, d):
    # every other twelve customers close a ring, the rest are chains
    ring = table(spark, d, "customer").selectExpr("'x' AS parent_type", "CAST(c_custkey - c_custkey % 12 + (c_custkey + 1) % 12 AS STRING) AS parent_id", "'x' AS child_type", "CAST(c_custkey AS STRING) AS child_id", "c_custkey").where("c_custkey % 24 < 12 OR c_custkey % 12 < 11")
    return ln.detect_cycles(ring.drop("c_custkey"))


@query("g6_impact", REGION_SQL + " SELECT root, split_part(node, '/', 1) AS artifact_type, count(*) AS n FROM down WHERE depth > 0 GROUP BY ALL")
def g6(spark, d):
    return ln.impact(roots(spark, d, "ingestion"), edges(spark, d), versions(spark, d))[0]


@query("g6_impact_versions", REGION_SQL + " SELECT DISTINCT root, dataset_name, version FROM down JOIN ver ON node = 'package/' || package_id")
def g6_versions(spark, d):
    return ln.impact(roots(spark, d, "ingestion"), edges(spark, d), versions(spark, d))[1]


_STATUS = "eff AS (SELECT ver.*, coalesce(x.s, CASE WHEN package_id IN (SELECT split_part(root, '/', 2) FROM chain WHERE root LIKE 'package/%' AND state = 'invalid') THEN 'affected' ELSE 'healthy' END) AS effective_status FROM ver LEFT JOIN (SELECT dataset_name, version, arg_max(new_state, event_id) AS s FROM vev GROUP BY ALL) x USING (dataset_name, version))"


@query("g7_enriched_impact", CUSTOMER_SQL + f", {_STATUS}, dn AS (SELECT down.*, coalesce(state, 'active') AS state FROM down LEFT JOIN state ON name = node) SELECT root, max(state) FILTER (depth = 0) AS own_state, count(*) FILTER (depth > 0 AND state = 'active') AS active_descendants, coalesce((SELECT count(*) FROM dn e JOIN eff ON e.node = 'package/' || package_id WHERE e.root = dn.root AND depth > 0), 0) AS versions, coalesce((SELECT count(*) FROM dn e JOIN eff ON e.node = 'package/' || package_id WHERE e.root = dn.root AND effective_status <> 'healthy'), 0) AS unhealthy_versions FROM dn GROUP BY root")
def g7(spark, d):
    return ln.enriched_impact(roots(spark, d, "integrity"), edges(spark, d), versions(spark, d), governance(spark, d), version_events(spark, d)).select("root", "own_state", "active_descendants", "versions", "unhealthy_versions")


@query("g8_governance_state", REGION_SQL + " SELECT name, state FROM state")
def g8(spark, d):
    return ln.governance_state(governance(spark, d)).select(ln.node("artifact_type", "artifact_id").alias("name"), "state")


@query("g9_governance_chain", REGION_SQL + " SELECT root, node, depth, state FROM chain WHERE root LIKE 'package/%' AND (depth = 0 OR state <> 'active')")
def g9(spark, d):
    return ln.governance_chain(roots(spark, d, "package"), edges(spark, d), governance(spark, d))


_GATE = "SELECT root, reason IS NULL AS open, reason FROM (SELECT root, CASE WHEN bool_or(depth = 0 AND state = 'invalid') THEN 'INVALID' WHEN bool_or(depth > 0 AND state = 'invalid') THEN 'INVALID_ANCESTOR' WHEN bool_or(depth = 0 AND state = 'deprecated') AND NOT {allow} THEN 'DEPRECATED' WHEN bool_or(depth > 0 AND state = 'deprecated') AND NOT {allow} THEN 'DEPRECATED_ANCESTOR' END AS reason FROM chain WHERE root LIKE 'package/%' GROUP BY root)"


@query("g10_upstream_gate", f"{REGION_SQL} {_GATE.format(allow='FALSE')}")
def g10(spark, d):
    return ln.upstream_gate(roots(spark, d, "package"), edges(spark, d), governance(spark, d))


@query("g10_upstream_gate_lenient", f"{REGION_SQL} {_GATE.format(allow='TRUE')}")
def g10_lenient(spark, d):
    return ln.upstream_gate(roots(spark, d, "package"), edges(spark, d), governance(spark, d), allow_deprecated=True)


@query("g11_effective_version_status", f"{REGION_SQL}, {_STATUS} SELECT dataset_name, version, package_id, effective_status FROM eff")
def g11(spark, d):
    return ln.effective_version_status(versions(spark, d), edges(spark, d), governance(spark, d), version_events(spark, d))


@query(
    "g12_register_version",
    REGION_SQL
    + """, ex AS (SELECT dataset_name, version, min(package_id) AS old FROM ver WHERE package_id::BIGINT % 20 = 0 GROUP BY ALL), ok AS (SELECT o_orderkey::VARCHAR AS package_id, o_orderstatus <> 'F' AS accepted FROM orders),
 j AS (SELECT ver.*, old, accepted, min(package_id) FILTER (accepted) OVER (PARTITION BY dataset_name, version) AS first FROM ver LEFT JOIN ex USING (dataset_name, version) LEFT JOIN ok USING (package_id))
 SELECT dataset_name, version, package_id, CASE WHEN old = package_id THEN 'unchanged' WHEN old IS NOT NULL THEN 'conflict' WHEN NOT accepted THEN 'rejected' WHEN first = package_id THEN 'created' ELSE 'conflict' END AS outcome FROM j""",
)
def g12(spark, d):
    asked = versions(spark, d)
    existing = asked.where("CAST(package_id AS BIGINT) % 20 = 0").groupBy("dataset_name", "version").agg(F.min("package_id").alias("package_id"))
    ok = table(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS package_id", "o_orderstatus <> 'F' AS accepted")
    return ln.register_versions(asked, existing, ok)


@query("g13_semver_latest", REGION_SQL + " SELECT dataset_name, arg_max(version, string_split(version, '.')::INT[]) AS latest FROM ver GROUP BY 1")
def g13(spark, d):
    return ln.semver_latest(versions(spark, d))


@query("g14_lineage_fingerprint", REGION_SQL + " SELECT root, sha256(string_agg(DISTINCT split_part(node, '/', 1) || ':' || sha256(split_part(node, '/', 2)), chr(10) ORDER BY split_part(node, '/', 1) || ':' || sha256(split_part(node, '/', 2)))) AS fingerprint FROM up WHERE root LIKE 'package/%' GROUP BY root")
def g14(spark, d):
    return ln.lineage_fingerprint(roots(spark, d, "package"), edges(spark, d), artifacts(spark, d))


@query("g15_verify_checksums", "SELECT o_orderkey::VARCHAR AS path, CASE WHEN o_orderkey % 5 = 0 THEN 'missing' WHEN o_orderkey % 7 = 0 THEN 'checksum_mismatch' WHEN o_orderkey % 11 = 0 THEN 'manifest_mismatch' ELSE 'verified' END AS result FROM orders")
def g15(spark, d):
    orders = table(spark, d, "orders")
    recorded = orders.selectExpr("CAST(o_orderkey AS STRING) AS path", "sha2(CAST(o_orderkey AS STRING), 256) AS sha256", "'m' AS recorded_manifest_sha256", "CASE WHEN o_orderkey % 11 = 0 THEN 'n' ELSE 'm' END AS manifest_sha256")
    actual = orders.where("o_orderkey % 5 <> 0").selectExpr("CAST(o_orderkey AS STRING) AS path", "sha2(CASE WHEN o_orderkey % 7 = 0 THEN 'other' ELSE CAST(o_orderkey AS STRING) END, 256) AS found_sha256")
    return ln.verify_checksums(recorded, actual)


@query("g15_verify_ancestors", REGION_SQL + ", res AS (SELECT name AS node, CASE WHEN split_part(name, '/', 2)::BIGINT % 7 = 0 THEN 'checksum_mismatch' WHEN split_part(name, '/', 2)::BIGINT % 11 = 0 THEN 'manifest_mismatch' ELSE 'verified' END AS result FROM node WHERE split_part(name, '/', 2)::BIGINT % 5 <> 0), j AS (SELECT root, coalesce(result, 'missing') AS result FROM up LEFT JOIN res USING (node) WHERE root LIKE 'package/%') SELECT root, count(*) AS artifacts, count(*) FILTER (result = 'verified') AS verified, count(*) FILTER (result = 'missing') AS missing, count(*) FILTER (result = 'checksum_mismatch') AS checksum_mismatch, count(*) FILTER (result = 'manifest_mismatch') AS manifest_mismatch, count(*) = count(*) FILTER (result = 'verified') AS passed FROM j GROUP BY root")
def g15_ancestors(spark, d):
    ids = F.col("artifact_id").cast("long")
    known = artifacts(spark, d).where(ids % 5 != 0)
    results = known.select(ln.node("artifact_type", "artifact_id").alias("node"), F.when(ids % 7 == 0, "checksum_mismatch").when(ids % 11 == 0, "manifest_mismatch").otherwise("verified").alias("result"))
    return ln.verify_ancestors(roots(spark, d, "package"), edges(spark, d), results)


@query("g16_catalog_health", REGION_SQL + ", known AS (SELECT name FROM node WHERE NOT (name LIKE 'integrity/%' AND split_part(name, '/', 2)::BIGINT % 10 = 0) AND NOT (name LIKE 'package/%' AND split_part(name, '/', 2)::BIGINT % 30 = 0)) SELECT 'dangling_version' AS problem, 'package/' || package_id AS name FROM (SELECT DISTINCT package_id FROM ver) WHERE package_id::BIGINT % 30 = 0 UNION ALL SELECT 'dangling_governance', name FROM (SELECT DISTINCT t || '/' || id AS name FROM ev) WHERE name NOT IN (SELECT name FROM known) UNION ALL SELECT DISTINCT 'missing_parent', parent FROM node WHERE parent IS NOT NULL AND parent NOT IN (SELECT name FROM known)")
def g16(spark, d):
    known = artifacts(spark, d).where("NOT (artifact_type = 'integrity' AND CAST(artifact_id AS BIGINT) % 10 = 0) AND NOT (artifact_type = 'package' AND CAST(artifact_id AS BIGINT) % 30 = 0)")
    return ln.catalog_health(known, edges(spark, d), governance(spark, d), versions(spark, d))


@query("g17_affected_closure", REGION_SQL + " SELECT root, down.node, depth AS level, parent, TRUE AS parent_replaced FROM down JOIN node ON node.name = down.node WHERE depth > 0")
def g17(spark, d):
    return ln.affected_closure(roots(spark, d, "ingestion"), edges(spark, d))


@query("g17_replacement_conflicts", "SELECT 'package/' || a.o_orderkey AS old, 'package/' || b.o_orderkey AS new, 'session_id' AS field FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_orderkey % 9 <> b.o_orderkey % 9 UNION ALL SELECT 'package/' || o_orderkey, 'package/' || (o_orderkey + 1), 'node' FROM orders WHERE o_orderkey + 1 NOT IN (SELECT o_orderkey FROM orders)")
def g17_conflicts(spark, d):
    pairs = table(spark, d, "orders").selectExpr("concat('package/', o_orderkey) AS old", "concat('package/', o_orderkey + 1) AS new")
    return ln.replacement_conflicts(pairs, artifacts(spark, d))


@query("g18_artifact_detail", REGION_SQL + " SELECT name, parent AS parents, coalesce((SELECT count(*) FROM node c WHERE c.parent = node.name), 0) AS n_children FROM node WHERE name LIKE 'integrity/%'")
def g18(spark, d):
    out = ln.artifact_detail(artifacts(spark, d), edges(spark, d), kind="integrity")
    return out.select("name", F.array_join("parents", ",").alias("parents"), F.size("children").cast("long").alias("n_children"))


@query("g19_rescan_conflicts", REGION_SQL + " SELECT artifact_type, artifact_id, CASE WHEN artifact_id::BIGINT % 6 = 0 THEN 'new' WHEN artifact_id::BIGINT % 7 = 0 THEN 'conflict' ELSE 'unchanged' END AS outcome FROM art")
def g19(spark, d):
    art = artifacts(spark, d)
    known = art.where("CAST(artifact_id AS BIGINT) % 6 <> 0").withColumn("content_sha256", F.expr("CASE WHEN CAST(artifact_id AS BIGINT) % 7 = 0 THEN 'old' ELSE content_sha256 END"))
    return ln.rescan_conflicts(known, art, ["content_sha256", "session_id"])


@query("g20_execution_key", "SELECT o_orderkey, sha256('clean:' || o_custkey || ':' || o_orderstatus || ':cfg:1.0.0') AS execution_key FROM orders WHERE o_custkey % 3 <> 0")
def g20(spark, d):
    orders = table(spark, d, "orders").withColumn("execution_key", ln.execution_key(F.lit("clean"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.lit("cfg"), F.lit("1.0.0")))
    return ln.pending(orders, orders.where("o_custkey % 3 = 0")).select("o_orderkey", "execution_key")


@query("g21_package_results", REGION_SQL + " SELECT o_orderkey::VARCHAR AS package_id, coalesce(tr, 0)::BIGINT AS train_samples, coalesce(te, 0)::BIGINT AS test_samples, o_orderstatus AS qc_status, coalesce(regs, '') AS registrations FROM orders LEFT JOIN (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS tr, count(*) FILTER (l_returnflag = 'R') AS te FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey LEFT JOIN (SELECT package_id, string_agg(dataset_name || '@' || version, ',' ORDER BY dataset_name || '@' || version) AS regs FROM ver GROUP BY 1) v ON v.package_id = o_orderkey::VARCHAR")
def g21(spark, d):
    orders = table(spark, d, "orders")
    index = table(spark, d, "lineitem").selectExpr("CAST(l_orderkey AS STRING) AS package_id", "CASE l_returnflag WHEN 'A' THEN 'train' WHEN 'R' THEN 'test' ELSE 'validation' END AS split")
    reports = orders.selectExpr("CAST(o_orderkey AS STRING) AS package_id", "o_orderstatus AS status", "0 AS error_count", "0 AS warning_count")
    out = ln.package_results(orders.selectExpr("CAST(o_orderkey AS STRING) AS package_id"), index, reports, versions(spark, d))
    return out.select("package_id", "train_samples", "test_samples", "qc_status", F.array_join("registrations", ",").alias("registrations"))


# Streaming: the events as a file stream, run to its end.
def live_events(spark, d):
    return spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")


def drained(spark, writer, checkpoint=None):
    """Runs a query over what there is and waits for it; with a checkpoint, from where that ends."""
    writer.option("checkpointLocation", checkpoint or fresh_path(spark, "stream")).trigger(availableNow=True).start().awaitTermination()


def collected(spark, df):
    path = fresh_path(spark, "streamed")
    drained(spark, df.writeStream.format("parquet").option("path", path).outputMode("append"))
    return spark.read.schema(df.schema).parquet(path)


def live_text(spark, d):
    """Raw text records of the live feed; the planted faults need no order."""
    df = live_events(spark, d).where("event_type = 'view'")
    return df.selectExpr(
        "CAST(user_id AS STRING) AS session_id",
        "event_id AS record_number",
        "date_format(CAST(ts AS TIMESTAMP), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || CASE WHEN event_id % 47 = 0 THEN '' ELSE 'Z' END AS timestamp",
        "CASE WHEN event_id % 97 = 0 THEN 'abc' WHEN event_id % 89 = 0 THEN ' ' WHEN event_id % 83 = 0 THEN 'nan' ELSE CAST(event_id % 150 AS STRING) || '.5' END AS accel_x",
        "'1' AS accel_y",
        "'9.75' AS accel_z",
    )


@query("t1_stream_validate_normalize", "SELECT event_id AS record_number, epoch_us(ts) AS epoch_us, round((event_id % 150 + 0.5) * 9.80665, 6)::DOUBLE AS accel_x, TRUE AS good FROM events WHERE event_type = 'view' AND event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 47 <> 0 UNION ALL SELECT event_id, NULL, NULL, FALSE FROM events WHERE event_type = 'view' AND (event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 OR event_id % 47 = 0)")
def t1(spark, d):
    good, bad = fresh_path(spark, "good"), fresh_path(spark, "bad")
    writer = live.validate_normalize(live_text(spark, d), IMU, {"acceleration": "g", "angular_velocity": "rad/s"}, lambda df, n: df.write.mode("append").parquet(good), lambda df, n: df.write.mode("append").parquet(bad))
    drained(spark, writer)
    fine = spark.read.parquet(good).select("record_number", "epoch_us", F.round("accel_x", 6).alias("accel_x"), F.lit(True).alias("good"))
    return fine.unionByName(spark.read.parquet(bad).select("record_number", F.lit(None).cast("long").alias("epoch_us"), F.lit(None).cast("double").alias("accel_x"), F.lit(False).alias("good")))


@query("t1_stream_integrity", "SELECT event_id AS record_number, CASE WHEN event_id % 5 = 0 THEN 'latitude' WHEN event_id % 7 = 0 THEN 'speed' END AS bad_field FROM events WHERE event_type = 'click'")
def t1_integrity(spark, d):
    feed = live_events(spark, d).where("event_type = 'click'").selectExpr(
        "CAST(user_id AS STRING) AS session_id", "event_id AS record_number", "'2024-01-01T00:00:00Z' AS timestamp", "CASE WHEN event_id % 5 = 0 THEN '91' ELSE '45.5' END AS latitude", "'9' AS longitude", "CASE WHEN event_id % 7 = 0 THEN '-1' ELSE '1' END AS speed"
    )
    good, bad = fresh_path(spark, "good"), fresh_path(spark, "bad")
    drained(spark, live.validate_normalize(feed, GPS, {"altitude": "m", "speed": "m/s"}, lambda df, n: df.write.mode("append").parquet(good), lambda df, n: df.write.mode("append").parquet(bad)))
    fine = spark.read.parquet(good).select("record_number", F.lit(None).cast("string").alias("bad_field"))
    return fine.unionByName(spark.read.parquet(bad).select("record_number", "bad_field"))


@contextmanager
def without_empty_batches(spark):
    """The rows that come next do what a micro-batch without rows would."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@query("t2_stream_order_check", "SELECT session_id, event_id AS record, CASE WHEN t < p THEN 'TIMESTAMP_OUT_OF_ORDER' ELSE 'DUPLICATE_TIMESTAMP' END AS code FROM (SELECT *, lag(t) OVER (PARTITION BY session_id ORDER BY event_id) AS p FROM (SELECT user_id::VARCHAR AS session_id, event_id, CASE WHEN event_id % 9 = 0 THEN 7 ELSE event_id END AS t FROM events)) WHERE t <= p")
def t2(spark, d):
    feed = live_events(spark, d).selectExpr("CAST(user_id AS STRING) AS session_id", "'all' AS stream", "event_id AS record_number", "CASE WHEN event_id % 9 = 0 THEN 7L ELSE event_id END AS epoch_us")
    return collected(spark, live.order_check(feed)).select("session_id", "record", "code")


@query("t3_stream_dedup", "SELECT user_id, value, count(DISTINCT event_type) AS kinds FROM events GROUP BY ALL")
def t3(spark, d):
    feed = live_events(spark, d).selectExpr("CAST(ts AS TIMESTAMP) AS ts", "user_id", "value", "event_type")
    twice = live.dedup(feed, "ts", ["user_id", "value", "event_type"], "365 days")
    return collected(spark, twice).groupBy("user_id", "value").agg(F.count("*").alias("kinds"))


@query("t4_stream_time_windows", "SELECT session_id, row_count, value_mean FROM (SELECT user_id::VARCHAR AS session_id, time_bucket(INTERVAL 6 HOUR, ts) AS w, count(*) AS row_count, round(avg(value), 6) AS value_mean FROM events GROUP BY ALL) WHERE w + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
def t4(spark, d):
    feed = live_events(spark, d).selectExpr("CAST(ts AS TIMESTAMP) AS ts", "CAST(user_id AS STRING) AS session_id", "value")
    out = collected(spark, live.time_windows(feed, "ts", ["value"], "6 hours", "6 hours", "1 hour"))
    return rounded(out.select("session_id", "row_count", "value_mean"))


@query("t4_anchored_windows", "WITH e AS (SELECT user_id::VARCHAR AS session_id, epoch_us(ts) AS us, value, min(epoch_us(ts)) OVER (PARTITION BY user_id) AS first, max(epoch_us(ts)) OVER (PARTITION BY user_id) AS last FROM events) SELECT session_id, (us - first) // 3600000000 AS k, count(*) AS row_count, round(avg(value), 6) AS value_mean, max(value)::DOUBLE AS value_max FROM e GROUP BY session_id, first, last, k HAVING last >= first + (k + 1) * 3600000000")
def t4_anchored(spark, d):
    """A feed of thirds in the order of time, and two late rows of another session that move the watermark past all others.

    Each part comes as many files, which are one micro-batch: the query is run to its end and goes on from its checkpoint.
    """
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("session_id"), F.col("ts").cast("timestamp").alias("t"), F.col("value").cast("double").alias("value"))
    low, high = events.agg(F.min(F.unix_micros("t")), F.max(F.unix_micros("t"))).first()
    third = F.floor((F.unix_micros("t") - F.lit(low)) * 3 / F.lit(high - low + 1))
    late = [spark.range(1).select(F.lit("end").alias("session_id"), F.timestamp_micros(F.lit(high + hours * 3_600_000_000)).alias("t"), F.lit(0.0).alias("value")) for hours in (48, 72)]
    source, out, checkpoint = fresh_path(spark, "feed"), fresh_path(spark, "windows"), fresh_path(spark, "stream")
    for part in [*(events.where(third == i) for i in range(3)), *late]:
        part.write.mode("append").parquet(source)
        feed = spark.readStream.schema(events.schema).parquet(source)
        found = live.anchored_windows(feed, "t", ["value"], 3_600_000, 3_600_000, "1 minute")
        with without_empty_batches(spark):
            drained(spark, found.writeStream.format("parquet").option("path", out), checkpoint)
    return rounded(spark.read.parquet(out).where("session_id <> 'end'").select("session_id", "k", "row_count", "value_mean", "value_max"))


@query("t5_stream_qc_profile", "WITH b AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events WHERE event_id % 2 = 0) SELECT 'value' AS path, count(*) AS present, round(avg(value), 6) AS mean, round((avg(value) - any_value(m)) / any_value(s), 6) AS score FROM events, b")
def t5(spark, d):
    base = qc.feature_profile(qc.long_form(table(spark, d, "events").where("event_id % 2 = 0"), ["value"]))
    out = fresh_path(spark, "profiles")
    feed = live_events(spark, d).select("value")
    drained(spark, live.qc_profile(feed, ["value"], base, lambda df, n: df.write.mode("append").parquet(out)))
    return rounded(spark.read.parquet(out).select("path", "present", "mean", "score"))


@query("t5_running_profile", "SELECT 'value' AS path, count(*) AS total, count(*) AS present, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max, TRUE AS near FROM events")
def t5_running(spark, d):
    """The profile after the last of several batches; near: each percentile's rank is within a hundredth."""
    events = table(spark, d, "events").select(F.col("value").cast("double").alias("value"))
    source, out = fresh_path(spark, "feed"), fresh_path(spark, "profiles")
    events.repartition(6).write.parquet(source)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    drained(spark, live.running_profile(feed, ["value"], fresh_path(spark, "state"), lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)))
    found = spark.read.parquet(out)
    last = found.join(found.agg(F.max("batch").alias("batch")), "batch")
    at = last.select("path", F.posexplode("percentiles").alias("i", "v"))
    ranks = events.crossJoin(F.broadcast(at)).groupBy("path", "i").agg(F.avg((F.col("value") <= F.col("v")).cast("double")).alias("r"))
    wanted = F.array(*map(F.lit, qc.PERCENTILES))
    near = ranks.groupBy("path").agg(F.min(F.abs(F.col("r") - wanted[F.col("i")]) <= 0.01).alias("near"))
    return rounded(last.join(near, "path").select("path", "total", "present", "mean", "std", "min", "max", "near"))


def piped(spark, d):
    return run_pipeline(streams(spark, d), PipelineConfig(tolerance_ms=HOURS_6_US / 1000, window=5, stride=3, features=FEATURES, grouping="session"))


@query(
    "run_pipeline",
    _report_sql(-1e300, 0, 1, 1)
    + f""", grouped AS (SELECT *, 'grp_' || left(sha256(session_id), 16) AS group_id FROM e), x AS (SELECT *, CASE WHEN {_share('group_id')} < 0.8 THEN 'train' WHEN {_share('group_id')} < 0.9 THEN 'validation' ELSE 'test' END AS split FROM grouped)
SELECT (SELECT count(*) FROM imu) AS rows, 0 AS dropped, count(*) AS samples, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test,
 (SELECT count(*) FROM report WHERE severity = 'error') AS qc_errors, (SELECT count(*) FROM report WHERE severity = 'warning') AS qc_warnings, CASE WHEN (SELECT count(*) FROM report WHERE severity = 'error') > 0 THEN 'failed' WHEN (SELECT count(*) FROM report) > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS qc_status, TRUE AS audited,
 CASE WHEN count(*) FILTER (split = 'train') = 0 OR count(*) FILTER (split = 'validation') = 0 OR count(*) FILTER (split = 'test') = 0 THEN 'rejected' ELSE 'completed' END AS package_status FROM x""",
)
def whole(spark, d):
    """One row of what each part of the pipeline comes to: all of them run."""
    r = piped(spark, d)
    counts = r.stats.agg(F.sum("samples").alias("samples"), *(F.sum(F.when(F.col("split") == s, F.col("samples")).otherwise(0)).alias(s) for s in pk.SPLITS))
    parts = [
        r.rows.agg(F.count("*").alias("rows")),
        r.dropped.agg(F.count("*").alias("dropped")),
        counts,
        r.report.select(F.col("error_count").alias("qc_errors"), F.col("warning_count").alias("qc_warnings"), F.col("status").alias("qc_status")),
        r.audit.select(F.col("passed").alias("audited")),
        r.status.select(F.col("status").alias("package_status")),
    ]
    return reduce(lambda a, b: a.crossJoin(b), parts)  # of one row each


@query("run_pipeline_samples", _PACKED + " SELECT session_id, k, sample_id, group_id, split FROM packed")
def whole_samples(spark, d):
    return piped(spark, d).samples.select("session_id", "k", "sample_id", "group_id", "split")
