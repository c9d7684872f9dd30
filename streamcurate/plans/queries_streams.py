"""Queries of alignment, cleaning, windows and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as cl
from ..operators import sync
from ..operators import windows as wn
from .registry import FEATURES, HOURS_6_US, SENSORS_SQL, SIZE, STRIDE, SYNC_SQL, WINDOWS_SQL, asof_sql, line_sql, query, rounded, samples, sensor, stats_sql, stream, streams, synced, windowed

HOUR_US = 3_600_000_000


@query("s1_to_stream", SENSORS_SQL + " SELECT session_id, record_number, epoch_us, round(accel_x, 6) AS accel_x FROM imu")
def s1(spark, d):
    return rounded(stream(spark, d, "imu").select("session_id", "record_number", "epoch_us", "payload.accel_x"))


@query("s2_assert_monotonic", SENSORS_SQL + f" SELECT session_id, record_number FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN epoch_us - {100 * HOUR_US} ELSE epoch_us END AS t, FROM imu) QUALIFY t < lag(t) OVER (PARTITION BY session_id ORDER BY record_number)")
def s2(spark, d):
    bent = sensor(spark, d, "imu").withColumn("epoch_us", F.when(F.col("event_id") % 9 == 0, F.col("epoch_us") - 100 * HOUR_US).otherwise(F.col("epoch_us")))
    return sync.disorder(bent).select("session_id", "record_number")


@query("s3_clock_correct", SENSORS_SQL + ", a AS (SELECT *, first_value(epoch_us) OVER (PARTITION BY session_id ORDER BY record_number) AS anchor FROM gps) SELECT session_id, record_number, round_even(anchor + (epoch_us - anchor) * (1 + 25.0::DOUBLE / 1e6) + 1500.0::DOUBLE, 0)::BIGINT AS epoch_us FROM a")
def s3(spark, d):
    return sync.clock_correct(stream(spark, d, "gps"), offset_ms=1.5, drift_ppm=25.0).select("session_id", "record_number", "epoch_us")


_NEAR = SENSORS_SQL + ",\n" + asof_sql("imu", "gps", ["latitude"], "g") + f" SELECT session_id, record_number AS target_no, near_us IS NOT NULL AND near_us <= {HOURS_6_US} AS matched, CASE WHEN near_us <= {HOURS_6_US} THEN round(near_us / 1000.0, 6) END AS delta_ms, CASE WHEN near_us <= {HOURS_6_US} THEN round(CASE WHEN use_prev THEN p_latitude ELSE n_latitude END, 6) END AS latitude, CASE WHEN near_us IS NULL THEN 'NO_DATA' WHEN near_us > {HOURS_6_US} THEN 'OUTSIDE_TOLERANCE' END AS reason FROM g"


def near(spark, d, bucket_us="auto"):
    found = sync.neighbours(sync.timeline_reference(stream(spark, d, "imu")), {"gps": stream(spark, d, "gps")}, bucket_us)
    value, note = sync.nearest("gps", HOURS_6_US)
    out = found.select("session_id", "target_no", value.alias("v"), note.alias("a"))
    return out.select("session_id", "target_no", "a.matched", F.round("a.delta_ms", 6).alias("delta_ms"), F.round("v.latitude", 6).alias("latitude"), "a.reason")


@query("s4_asof_nearest", _NEAR)
def s4(spark, d):
    return near(spark, d)


@query("s4_asof_nearest_bucketed", _NEAR)
def s4_bucketed(spark, d):
    return near(spark, d, bucket_us=24 * HOUR_US)


@query("s5_asof_linear", SENSORS_SQL + ",\n" + asof_sql("imu", "force_torque", ["force_x"], "f") + f" SELECT session_id, record_number AS target_no, line_ok AS matched, CASE WHEN line_ok THEN round(line_us / 1000.0, 6) END AS delta_ms, round({line_sql('force_x')}, 6) AS force_x FROM f")
def s5(spark, d):
    ft = stream(spark, d, "force_torque")
    found = sync.neighbours(sync.timeline_reference(stream(spark, d, "imu")), {"ft": ft})
    value, note = sync.linear("ft", HOURS_6_US, ft.schema["payload"].dataType)
    out = found.select("session_id", "target_no", value.alias("v"), note.alias("a"))
    return out.select("session_id", "target_no", "a.matched", F.round("a.delta_ms", 6).alias("delta_ms"), F.round("v.force_x", 6).alias("force_x"))


@query("s6_timeline_reference", SENSORS_SQL + " SELECT session_id, record_number AS target_no, epoch_us FROM gps")
def s6(spark, d):
    return sync.timeline_reference(stream(spark, d, "gps"))


_SPANS = SENSORS_SQL + ", ends AS (SELECT session_id, min(epoch_us) AS a, max(epoch_us) AS b FROM imu GROUP BY 1 UNION ALL SELECT session_id, min(epoch_us), max(epoch_us) FROM gps GROUP BY 1), spans AS (SELECT session_id, max(a) AS start_us, min(b) AS end_us FROM ends GROUP BY 1 HAVING count(*) = 2)"


@query("s7_timeline_fixed_rate", _SPANS + " SELECT session_id, epoch_us FROM (SELECT session_id, unnest(generate_series(start_us, end_us, 10000000000)) AS epoch_us FROM spans WHERE start_us <= end_us)")
def s7(spark, d):
    return sync.timeline_fixed_rate({n: stream(spark, d, n) for n in ("imu", "gps")}, 0.0001).select("session_id", "epoch_us")


@query("s8_intersection_interval", _SPANS + " SELECT * FROM spans")
def s8(spark, d):
    return sync.intersection_interval({n: stream(spark, d, n) for n in ("imu", "gps")})


def flat(rows):
    return rounded(
        rows.select("session_id", "row_index", "epoch_us", F.col("streams.imu.accel_x").alias("accel_x"), F.col("streams.gps.latitude").alias("latitude"), F.col("streams.force_torque.force_x").alias("force_x"), F.col("alignment.gps.matched").alias("gps_ok"), F.col("alignment.force_torque.matched").alias("ft_ok"))
    )


_FLAT = SYNC_SQL + " SELECT session_id, row_index, epoch_us, round(accel_x, 6) AS accel_x, round(latitude, 6) AS latitude, round(force_x, 6) AS force_x, gps_ok, ft_ok FROM rows_"


@query("s9_synchronize", _FLAT)
def s9(spark, d):
    return flat(synced(spark, d))


@query("s9_synchronize_bucketed", _FLAT)
def s9_bucketed(spark, d):
    return flat(synced(spark, d, bucket_us=48 * HOUR_US))


@query(
    "s10_sync_metrics",
    SYNC_SQL
    + """ SELECT 'gps' AS stream, count(*) AS rows, count(*) FILTER (gps_ok) AS matched, round(avg(gps_ok::INT), 6) AS coverage, round(sum(round(gps_ms * 1000)::BIGINT) FILTER (gps_ok) / count(gps_ms) FILTER (gps_ok) / 1000.0, 3) AS mean_delta_ms, NULL::BIGINT AS interpolated FROM rows_
 UNION ALL SELECT 'force_torque', count(*), count(*) FILTER (ft_ok), round(avg(ft_ok::INT), 6), round(sum(round(ft_ms * 1000)::BIGINT) FILTER (ft_ok) / count(ft_ms) FILTER (ft_ok) / 1000.0, 3), count(*) FILTER (ft_ok AND ft_ms > 0) FROM rows_
 UNION ALL SELECT 'imu', count(*), count(*), 1.0, 0.0, NULL FROM rows_""",
)
def s10(spark, d):
    return sync.sync_metrics(synced(spark, d)).select("stream", "rows", "matched", F.round("coverage", 6).alias("coverage"), F.round("mean_delta_ms", 3).alias("mean_delta_ms"), "interpolated")


@query("l1_required_streams", SYNC_SQL + " SELECT session_id, row_index, concat_ws(',', CASE WHEN NOT gps_ok THEN 'MISSING_REQUIRED_STREAM/gps' END, CASE WHEN NOT ft_ok THEN 'MISSING_REQUIRED_STREAM/force_torque' END) AS reasons FROM rows_")
def l1(spark, d):
    return synced(spark, d).select("session_id", "row_index", F.array_join(F.transform(cl.required_streams(["gps", "force_torque"]), lambda r: F.concat_ws("/", r["code"], r["stream"])), ",").alias("reasons"))


@query("l2_min_present_streams", SYNC_SQL + " SELECT session_id, row_index FROM rows_ WHERE 1 + gps_ok::INT + ft_ok::INT < 3")
def l2(spark, d):
    return synced(spark, d).where(cl.min_present_streams(["imu", "gps", "force_torque"], 3).isNotNull()).select("session_id", "row_index")


@query("l3_all_optional_missing", SYNC_SQL + " SELECT session_id, row_index FROM rows_ WHERE NOT gps_ok AND NOT ft_ok")
def l3(spark, d):
    return synced(spark, d).where(cl.all_optional_missing(["imu", "gps", "force_torque"], ["imu"]).isNotNull()).select("session_id", "row_index")


@query("l4_dedup_exact", "SELECT doc_id AS row_index, CASE WHEN doc_id > first THEN first END AS duplicate_of_row_index FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)")
def l4(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = docs.select(F.lit("all").alias("session_id"), F.col("doc_id").alias("row_index"), "text")
    return cl.dedup_exact(rows, F.coalesce(F.sha2("text", 256), F.lit("null"))).select("row_index", "duplicate_of_row_index")


@query("l5_redact", SYNC_SQL + " SELECT session_id, row_index, NULL::DOUBLE AS latitude, round(longitude, 6) AS longitude, gps_ok::INT AS n_redacted FROM rows_")
def l5(spark, d):
    out = cl.redact(synced(spark, d), ["gps.latitude", "gps.nothing", "other.x"])
    return out.select("session_id", "row_index", F.col("streams.gps.latitude").alias("latitude"), F.round("streams.gps.longitude", 6).alias("longitude"), "n_redacted")


def cleaned(spark, d):
    return cl.clean(synced(spark, d), required=["force_torque"], least=2, redact_paths=["gps.latitude"])


@query("l6_clean", SYNC_SQL + " SELECT session_id, row_index, round(longitude, 6) AS longitude, gps_ok::INT AS n_redacted FROM rows_ WHERE ft_ok")
def l6(spark, d):
    kept, _ = cleaned(spark, d)
    return kept.select("session_id", "row_index", F.round("streams.gps.longitude", 6).alias("longitude"), "n_redacted")


_REPORT = SYNC_SQL + " SELECT session_id, count(*) AS input_rows, count(*) FILTER (ft_ok) AS retained_rows, count(*) FILTER (NOT ft_ok) AS dropped_rows, count(*) FILTER (ft_ok AND gps_ok) AS redacted_rows, round(avg(ft_ok::INT), 6) AS retention_ratio, CASE WHEN count(*) FILTER (ft_ok) < 5 THEN 'rejected' ELSE 'completed' END AS status FROM rows_ GROUP BY session_id"


@query("l7_cleaning_report", _REPORT)
def l7(spark, d):
    return rounded(cl.cleaning_report(*cleaned(spark, d), minimum_retained_rows=5).select("session_id", "input_rows", "retained_rows", "dropped_rows", "redacted_rows", "retention_ratio", "status"))


@query("l7_reason_counts", SYNC_SQL + " SELECT 'MISSING_REQUIRED_STREAM' AS reason, count(*) AS n FROM rows_ WHERE NOT ft_ok HAVING count(*) > 0 UNION ALL SELECT 'FIELD_REDACTED', count(*) FROM rows_ WHERE ft_ok AND gps_ok HAVING count(*) > 0")
def l7_reasons(spark, d):
    kept, dropped = cleaned(spark, d)
    return cl.reason_counts(dropped, kept)


@query("l7_redaction_examples", SYNC_SQL + " SELECT session_id, row_index, 'FIELD_REDACTED:gps.latitude' AS redaction FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY row_index) AS position FROM rows_ WHERE ft_ok AND gps_ok) WHERE position <= 3")
def l7_examples(spark, d):
    found = cl.redaction_examples(cleaned(spark, d)[0], 3)
    return found.select("session_id", "row_index", F.array_join(F.transform("redactions", lambda r: F.concat_ws(":", r["code"], r["field"])), ",").alias("redaction"))


@query("l8_cleaning_status", SYNC_SQL + " SELECT session_id, CASE WHEN count(*) FILTER (ft_ok) < 8 THEN 'rejected' ELSE 'completed' END AS status FROM rows_ GROUP BY session_id")
def l8(spark, d):
    return cl.cleaning_report(*cleaned(spark, d), minimum_retained_rows=8).select("session_id", "status")


@query("w1_count_windows", WINDOWS_SQL.replace(f"(n - {SIZE}) // {STRIDE} ELSE -1 END", f"(n - {SIZE}) // {STRIDE} + 1 ELSE 0 END") + " SELECT session_id, k, count(*) AS row_count, min(row_index) AS first_row, max(row_index) AS last_row FROM w GROUP BY ALL")
def w1(spark, d):
    return windowed(spark, d, drop_incomplete=False).groupBy("session_id", "k").agg(F.count("*").alias("row_count"), F.min("row_index").alias("first_row"), F.max("row_index").alias("last_row"))


_TIME = SENSORS_SQL + f", r AS (SELECT session_id, epoch_us - min(epoch_us) OVER (PARTITION BY session_id) AS rel, max(epoch_us) OVER (PARTITION BY session_id) - min(epoch_us) OVER (PARTITION BY session_id) AS span FROM imu), x AS (SELECT session_id, span, unnest(generate_series(rel // {HOUR_US // 2} - 2, rel // {HOUR_US // 2} + 1)) AS k, rel FROM r) SELECT session_id, k, count(*) AS row_count FROM x WHERE k >= 0 AND rel >= k * {HOUR_US // 2} AND rel < k * {HOUR_US // 2} + {HOUR_US}"


def in_time(spark, d, drop):
    rows = sensor(spark, d, "imu")
    return wn.time_windows(rows, 3_600_000, 1_800_000, drop).groupBy("session_id", "k").agg(F.count("*").alias("row_count"))


@query("w2_time_windows", _TIME + f" AND span >= k * {HOUR_US // 2} + {HOUR_US} GROUP BY ALL")
def w2(spark, d):
    return in_time(spark, d, True)


@query("w2_time_windows_incomplete", _TIME + " GROUP BY ALL")
def w2_all(spark, d):
    return in_time(spark, d, False)


@query("w3_assert_row_order", SENSORS_SQL + " SELECT session_id, count(*) AS n FROM gps GROUP BY 1")
def w3(spark, d):
    rows = sensor(spark, d, "gps").withColumnRenamed("record_number", "row_index")
    return wn.assert_row_order(rows).groupBy("session_id").agg(F.count(F.when(F.col("epoch_us") > 0, 1)).alias("n"))


def stat_query(spark, d, value, name):
    return rounded(windowed(spark, d).groupBy("session_id", "k").agg(*(wn.statistic(value, s).alias(f"{name}_{s}") for s in wn.STATISTICS)))


@query("f1_window_stats", WINDOWS_SQL + f" SELECT session_id, k, {stats_sql('altitude', 'altitude')} FROM w GROUP BY ALL")
def f1(spark, d):
    return stat_query(spark, d, F.col("streams.gps.altitude"), "altitude")


@query("f2_raw_sequences", WINDOWS_SQL + " SELECT session_id, k, coalesce(string_agg(round(altitude * 100)::BIGINT::VARCHAR, ',' ORDER BY row_index) FILTER (altitude IS NOT NULL), '') AS altitude FROM w GROUP BY ALL")
def f2(spark, d):
    raw = wn.raw_sequence(F.col("streams.gps.altitude"))
    return windowed(spark, d).groupBy("session_id", "k").agg(raw.alias("v")).select("session_id", "k", F.array_join(F.transform("v", lambda x: F.round(x * 100).cast("long").cast("string")), ",").alias("altitude"))


@query("f3_imu_magnitudes", WINDOWS_SQL + f", m AS (SELECT *, sqrt(accel_x * accel_x + accel_y * accel_y + accel_z * accel_z) AS mag FROM w) SELECT session_id, k, {stats_sql('mag', 'mag')} FROM m GROUP BY ALL")
def f3(spark, d):
    return stat_query(spark, d, wn.magnitude([F.col(f"streams.imu.accel_{a}") for a in "xyz"]), "mag")


@query("f4_force_torque_magnitudes", WINDOWS_SQL + f", m AS (SELECT *, sqrt(3 * force_x * force_x) AS mag FROM w) SELECT session_id, k, {stats_sql('mag', 'mag')} FROM m GROUP BY ALL")
def f4(spark, d):
    return stat_query(spark, d, wn.magnitude([F.col(f"streams.force_torque.force_{a}") for a in "xyz"]), "mag")


@query(
    "f5_displacement",
    WINDOWS_SQL
    + """, e AS (SELECT session_id, k, count(latitude) AS n, radians(arg_min(latitude, row_index) FILTER (latitude IS NOT NULL)) AS a, radians(arg_max(latitude, row_index) FILTER (latitude IS NOT NULL)) AS b, radians(arg_min(longitude, row_index) FILTER (longitude IS NOT NULL)) AS c, radians(arg_max(longitude, row_index) FILTER (longitude IS NOT NULL)) AS d FROM w GROUP BY ALL)
 SELECT session_id, k, CASE WHEN n >= 2 THEN round(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin((b - a) / 2), 2) + cos(a) * cos(b) * pow(sin((d - c) / 2), 2)))), 3) END AS displacement_m FROM e""",
)
def f5(spark, d):
    return rounded(windowed(spark, d).groupBy("session_id", "k").agg(wn.displacement_m(F.col("streams.gps.latitude"), F.col("streams.gps.longitude")).alias("displacement_m")), 3)


@query("f6_modality_mask", WINDOWS_SQL + " SELECT session_id, k, bool_or(gps_ok) AS gps, bool_or(ft_ok) AS force_torque FROM w GROUP BY ALL")
def f6(spark, d):
    return samples(spark, d).select("session_id", "k", "modality_mask.gps", "modality_mask.force_torque")


@query("f7_modality_coverage", WINDOWS_SQL + " SELECT session_id, k, round(avg(gps_ok::INT), 6) AS gps, round(avg(ft_ok::INT), 6) AS force_torque FROM w GROUP BY ALL")
def f7(spark, d):
    return rounded(samples(spark, d).select("session_id", "k", "modality_coverage.gps", "modality_coverage.force_torque"))


@query("f8_relative_time", WINDOWS_SQL + ", s AS (SELECT *, epoch_us - min(epoch_us) OVER (PARTITION BY session_id, k) AS rel FROM w) SELECT session_id, k, string_agg((rel // 1000)::VARCHAR, ',' ORDER BY row_index) AS relative_ms FROM s GROUP BY ALL")
def f8(spark, d):
    out = wn.transform(windowed(spark, d), FEATURES, relative_time=True)
    return out.select("session_id", "k", F.array_join(F.transform("relative_time_ms", lambda x: F.floor(x).cast("string")), ",").alias("relative_ms"))


@query("f9_sample_id", WINDOWS_SQL + " SELECT session_id, k, 'sample_' || left(sha256('sha:cfg:' || session_id || '/' || k || ':' || min(epoch_us) || ':' || max(epoch_us)), 32) AS sample_id FROM w GROUP BY session_id, k")
def f9(spark, d):
    return wn.transform(windowed(spark, d), {}, "sha", "cfg").select("session_id", "k", "sample_id")


@query("f10_require_finite", WINDOWS_SQL + " SELECT session_id, k, round(sum(accel_x), 6) AS total FROM w GROUP BY ALL")
def f10(spark, d):
    return rounded(windowed(spark, d).groupBy("session_id", "k").agg(F.sum(wn.require_finite(F.col("streams.imu.accel_x"), "imu.accel_x")).alias("total")))


@query("f11_transform", WINDOWS_SQL + " SELECT session_id, k, count(*) AS row_count, min(row_index) AS source_row_start, max(row_index) AS source_row_end, round(avg(accel_x), 6) AS accel_x_mean, round(median(altitude), 6) AS altitude_median FROM w GROUP BY ALL")
def f11(spark, d):
    return rounded(samples(spark, d).select("session_id", "k", "row_count", "source_row_start", "source_row_end", F.col("features.imu.statistics.accel_x_mean").alias("accel_x_mean"), F.col("features.gps.statistics.altitude_median").alias("altitude_median")))


@query("f12_transform_report", WINDOWS_SQL + ", s AS (SELECT session_id, k, bool_or(gps_ok) AS g, bool_or(ft_ok) AS f FROM w GROUP BY ALL) SELECT 'gps' AS stream, 9 AS features, count(*) AS samples, 5.0 AS avg_rows, count(*) FILTER (g) AS windows_present, round(avg(g::INT), 6) AS present_ratio FROM s UNION ALL SELECT 'force_torque', 0, count(*), 5.0, count(*) FILTER (f), round(avg(f::INT), 6) FROM s UNION ALL SELECT 'imu', 27, count(*), 5.0, count(*), 1.0 FROM s")
def f12(spark, d):
    return rounded(wn.transform_report(samples(spark, d)))


@query("run_aligned_streams", SENSORS_SQL + " SELECT session_id, count(*) AS n FROM imu GROUP BY 1")
def all_streams(spark, d):
    return sync.synchronize(streams(spark, d), "imu", tolerance_ms=1.0).groupBy("session_id").agg(F.count("*").alias("n"))
