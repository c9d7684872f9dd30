"""Queries of the record operators: files, validation, integrity, normalization."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.storage import fresh_path
from ..operators import integrity as ig
from ..operators import normalize as nz
from ..operators import validate as va
from ..sources import files as fs
from ..sources.csv_splits import named, split_csv
from ..specs import GPS, IMU
from .registry import DIRTY_SQL, JSON_SQL, SENSORS_SQL, dirty, json_lines, query, sensor, table

UNITS = {"acceleration": "g", "angular_velocity": "deg/s"}
ISSUES = ["session_id", "file", "record", "field", "code"]
G, DEG = 9.80665, 0.017453292519943295


def text_columns(df):
    return df.select("session_id", "file", "record_number", "timestamp", "accel_x", "accel_y", "accel_z", "gyro_x")


def csv_folder(spark, d):
    path = fresh_path(spark, "csv")
    text_columns(dirty(spark, d)).drop("session_id", "file").withColumnRenamed("record_number", "number").repartition("number").sortWithinPartitions("number", "accel_x").write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("i1_read_csv", DIRTY_SQL + " SELECT record_number, timestamp, accel_x, gyro_x FROM dirty")
def i1(spark, d):
    found = split_csv(spark, csv_folder(spark, d))
    return named(found, ["number", "timestamp", "accel_x", "gyro_x"]).select(F.col("number").cast("long").alias("record_number"), "timestamp", "accel_x", "gyro_x")


def in_files(df, least=4):
    """As many parts as a scan has, so that none grows with the table; small tables are dealt out to `least`."""
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def csv_text(spark, lines, header):
    """A folder of files that begin with the header, one for each partition of the lines."""
    path = fresh_path(spark, "csv-text")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines.select(F.when(first, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value")).alias("value")).write.text(path)
    return path


def quoted(c: str):
    return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


@query("i1_quoted_texts", "SELECT doc_id, sha256(coalesce(text, '') || ' \"' || source || chr(10) || '\\') AS sha256, lang FROM documents")
def i1_quoted(spark, d):
    docs = table(spark, d, "documents").withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(' "'), "source", F.lit("\n\\")))
    found = fs.read_csv(spark, csv_text(spark, in_files(docs.select(F.concat_ws(",", "doc_id", quoted("text"), "lang").alias("value"))), "doc_id,text,lang"), ["lang", "doc_id", "text"])
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("sha256"), "lang")


@query("i1_two_headers", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status, o_custkey FROM orders")
def i1_headers(spark, d):
    orders = table(spark, d, "orders")
    one = csv_text(spark, orders.where("o_orderkey % 2 = 0").selectExpr("concat_ws(',', o_orderkey, o_orderstatus, o_custkey) AS value"), "key,status,customer")
    other = csv_text(spark, orders.where("o_orderkey % 2 = 1").selectExpr("concat_ws(',', o_custkey, o_orderkey) AS value"), "customer,key")
    found = fs.read_csv(spark, [one, other], ["key", "status", "customer"])
    return found.select(F.col("key").cast("long").alias("o_orderkey"), "status", F.col("customer").cast("long").alias("o_custkey"))


@query("i4_record_number_quoted", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS record_number FROM orders")
def i4_quoted(spark, d):
    path = fresh_path(spark, "csv-numbers")
    # newlines inside quotes, and blank lines between records
    cell = """concat('"', repeat('\n', int(o_orderkey % 3)), o_orderkey, '"', repeat('\n', int(o_orderkey % 2)))"""
    files = table(spark, d, "orders").groupBy((F.col("o_orderkey") % 8).alias("p")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.expr(cell).alias("cell")))).alias("a"))
    files.select("p", F.concat(F.lit("key\n"), F.array_join(F.col("a.cell"), "\n")).alias("value")).write.partitionBy("p").text(path)
    return fs.read_csv(spark, f"{path}/*", ["key"]).select(F.translate("key", "\n", "").cast("long").alias("o_orderkey"), "record_number")


@query("v1_header_of_files", "SELECT o_orderkey % 4 AS part, unnest(['accel_z', 'temperature']) AS field, unnest(['MISSING_REQUIRED_FIELD', 'UNEXPECTED_FIELD']) AS code FROM orders WHERE o_orderkey % 4 IN (0, 2) GROUP BY 1 UNION ALL SELECT o_orderkey % 4, 'timestamp', 'MISSING_REQUIRED_FIELD' FROM orders WHERE o_orderkey % 4 IN (1, 3) GROUP BY 1")
def v1_files(spark, d):
    orders = table(spark, d, "orders")
    heads = ["timestamp,accel_x,accel_y,temperature", "accel_z,accel_y,accel_x"]
    paths = [csv_text(spark, orders.where(f"o_orderkey % 4 = {k}").coalesce(1).selectExpr("concat_ws(',', o_orderkey, 1, 2) AS value"), heads[k % 2]) for k in range(4)]
    found = split_csv(spark, paths)
    part = found.records.where("record_number = 1").select("file", (F.col("cells")[0].cast("long") % 4).alias("part"))
    return va.header_issues(found.headers, IMU, ["file"]).join(part, "file").select("part", "field", "code")


@query("i2_read_jsonl", JSON_SQL + " SELECT value FROM lines")
def i2(spark, d):
    path = fresh_path(spark, "jsonl")
    json_lines(spark, d).select(F.concat("value", F.lit("\n")).alias("value")).write.text(path)
    return fs.read_jsonl(spark, path).select("value")


@query("i3_read_json", "SELECT event_id, value FROM events")
def i3(spark, d):
    path = fresh_path(spark, "json")
    events = table(spark, d, "events").withColumn("part", F.col("event_id") % 16)
    arrays = events.groupBy("part").agg(F.collect_list(F.struct("event_id", "value")).alias("a")).select(F.to_json("a").alias("value"))
    arrays.repartition(16).write.option("maxRecordsPerFile", 1).text(path)
    return fs.read_json(spark, path).select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), F.get_json_object("value", "$.value").cast("double").alias("value"))


@query("i4_record_number", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS record_number FROM orders")
def i4(spark, d):
    path = fresh_path(spark, "lines")
    orders = table(spark, d, "orders").withColumn("p", F.col("o_orderkey") % 8)
    orders.select("p", F.col("o_orderkey").cast("string").alias("value")).repartition("p").sortWithinPartitions("p", F.col("value").cast("long")).write.partitionBy("p").text(path)
    return fs.read_lines(spark, [f"{path}/p={p}" for p in range(8)]).select(F.col("value").cast("long").alias("o_orderkey"), "record_number")


@query("i5_ingest_manifest", "SELECT sha256(chr(10) || string_agg(o_orderpriority || o_orderkey, chr(10) ORDER BY o_orderkey)) AS sha256, 'anonymous' AS customer_id FROM orders GROUP BY o_orderkey % 25")
def i5(spark, d):
    path = fresh_path(spark, "files")
    orders = table(spark, d, "orders").selectExpr("o_orderkey % 25 AS part", "o_orderkey", "concat(o_orderpriority, o_orderkey) AS line")
    lines = orders.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "line"))).alias("a"))
    whole = lines.select("part", F.concat(F.lit("\n"), F.array_join(F.transform("a", lambda x: x["line"]), "\n")).alias("value"))
    whole.write.partitionBy("part").option("lineSep", "\x1e").text(path)
    made = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    trimmed = made.select("path", F.sha2(F.expr("substring(content, 1, length(content) - 1)"), 256).alias("sha256"))
    manifest = fs.ingest_manifest(spark, f"{path}/*/*", customer_id=" ")
    return manifest.select("path", "customer_id").join(trimmed, "path").select("sha256", "customer_id")


@query("i6_ingest_filter", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'EXTENSION_NOT_ALLOWED' WHEN o_orderkey % 7 = 0 THEN 'EMPTY_FILE' WHEN o_orderkey % 11 = 0 THEN 'FILE_TOO_LARGE' END AS reject_reason FROM orders")
def i6(spark, d):
    files = table(spark, d, "orders").selectExpr("o_orderkey", "concat('/in/', o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '.exe' ELSE '.CSV' END) AS path", "CASE WHEN o_orderkey % 7 = 0 THEN 0L WHEN o_orderkey % 11 = 0 THEN 536870913L ELSE 10L END AS length")
    return fs.ingest_filter(files).select("o_orderkey", "reject_reason")


@query("i7_write_normalized", SENSORS_SQL + " SELECT session_id, round(accel_x, 6) AS accel_x, round(gyro_x, 6) AS gyro_x FROM imu")
def i7(spark, d):
    path = fresh_path(spark, "normalized")
    df = sensor(spark, d, "imu").withColumns({"timestamp": tx.iso_utc(F.timestamp_micros("epoch_us")), "device_id": F.col("session_id")})
    fs.write_normalized(df, IMU, path, "jsonl")
    return spark.read.json(path, schema="device_id string, accel_x double, gyro_x double").select(F.col("device_id").alias("session_id"), F.round("accel_x", 6).alias("accel_x"), F.round("gyro_x", 6).alias("gyro_x"))


@query("i7_write_normalized_array", SENSORS_SQL + " SELECT session_id, round(accel_x, 6) AS accel_x FROM imu")
def i7_array(spark, d):
    path = fresh_path(spark, "normalized")
    df = sensor(spark, d, "imu").withColumns({"timestamp": tx.iso_utc(F.timestamp_micros("epoch_us")), "device_id": F.col("session_id")})
    fs.write_normalized(df, IMU, path, "json")
    rows = fs.read_json(spark, path).select(F.from_json("value", "device_id string, accel_x double").alias("r"))
    return rows.select(F.col("r.device_id").alias("session_id"), F.round("r.accel_x", 6).alias("accel_x"))


@query("v1_missing_required", JSON_SQL + " SELECT session_id, file, record_number AS record, 'accel_x' AS field, 'MISSING_REQUIRED_FIELD' AS code FROM lines WHERE ok AND event_id % 59 = 0")
def v1(spark, d):
    return va.key_issues(json_lines(spark, d), IMU).where("code = 'MISSING_REQUIRED_FIELD'").select(*ISSUES)


@query("v1_header", "SELECT user_id::VARCHAR AS session_id, user_id || '.csv' AS file, NULL::BIGINT AS record, unnest(['accel_z', 'temperature']) AS field, unnest(['MISSING_REQUIRED_FIELD', 'UNEXPECTED_FIELD']) AS code FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'view')")
def v1_header(spark, d):
    headers = dirty(spark, d).select("session_id", "file").distinct().withColumn("header", F.array(*map(F.lit, ["timestamp", "accel_x", "accel_y", "temperature"])))
    return va.header_issues(headers, IMU).select(*ISSUES)


@query("v2_unexpected_field", JSON_SQL + " SELECT session_id, file, record_number AS record, 'foo' AS field, 'UNEXPECTED_FIELD' AS code FROM lines WHERE ok AND event_id % 57 = 0")
def v2(spark, d):
    return va.key_issues(json_lines(spark, d), IMU).where("code = 'UNEXPECTED_FIELD'").select(*ISSUES)


@query("v3_null_not_allowed", DIRTY_SQL + " SELECT session_id, file, record_number AS record, 'accel_x' AS field, 'NULL_NOT_ALLOWED' AS code FROM dirty WHERE trim(accel_x) = ''")
def v3(spark, d):
    df = text_columns(dirty(spark, d))
    return va.gathered(df, va.null_checks(df, IMU), va.FILE).select(*ISSUES)


@query("v4_type_check_text", DIRTY_SQL + " SELECT session_id, file, record_number AS record, 'accel_x' AS field, 'INVALID_TYPE' AS code FROM dirty WHERE trim(accel_x) <> '' AND try_cast(accel_x AS DOUBLE) IS NULL")
def v4(spark, d):
    return va.validate_text(text_columns(dirty(spark, d)), IMU).where("code = 'INVALID_TYPE'").select(*ISSUES)


@query(
    "v5_type_check_native",
    JSON_SQL
    + """ SELECT session_id, file, record_number AS record, field, 'INVALID_TYPE' AS code FROM (
  SELECT *, 'accel_x' AS field FROM lines WHERE ok AND event_id % 59 <> 0 AND event_id % 51 = 0 UNION ALL
  SELECT *, 'accel_y' FROM lines WHERE ok AND event_id % 49 = 0 UNION ALL SELECT *, 'timestamp' FROM lines WHERE ok AND event_id % 41 = 0)""",
)
def v5(spark, d):
    return va.validate_json(json_lines(spark, d), IMU).where("code = 'INVALID_TYPE'").select(*ISSUES)


@query("v6_timestamp_check", DIRTY_SQL + " SELECT session_id, file, record_number AS record, 'timestamp' AS field, 'INVALID_TIMESTAMP' AS code FROM dirty WHERE timestamp NOT LIKE '%Z'")
def v6(spark, d):
    return va.validate_text(text_columns(dirty(spark, d)), IMU).where("code = 'INVALID_TIMESTAMP'").select(*ISSUES)


@query("v6_timestamp_check_native", JSON_SQL + " SELECT session_id, file, record_number AS record, 'timestamp' AS field, 'INVALID_TIMESTAMP' AS code FROM lines WHERE ok AND event_id % 41 <> 0 AND event_id % 43 = 0")
def v6_native(spark, d):
    return va.validate_json(json_lines(spark, d), IMU).where("code = 'INVALID_TIMESTAMP'").select(*ISSUES)


@query("v7_invalid_record", JSON_SQL + " SELECT session_id, file, record_number AS record, 'INVALID_RECORD' AS code FROM lines WHERE NOT ok")
def v7(spark, d):
    return va.invalid_json(json_lines(spark, d)).select("session_id", "file", "record", "code")


@query("v7_invalid_record_csv", "SELECT o_orderkey AS record, 'INVALID_RECORD' AS code FROM orders WHERE o_orderkey % 13 = 0")
def v7_csv(spark, d):
    lines = table(spark, d, "orders").selectExpr("""concat(o_orderkey, ',"a,\nb",', CASE WHEN o_orderkey % 13 = 0 THEN '1,2' ELSE '1' END) AS value""")
    found = split_csv(spark, csv_text(spark, lines, "number,name,x"))
    issues = va.invalid_csv(found.records, found.headers, ["file"])
    numbers = found.records.select("file", F.col("record_number").alias("record"), F.col("cells")[0].cast("long").alias("number"))
    return issues.join(numbers, ["file", "record"]).select(F.col("number").alias("record"), "code")


@query("v8_empty_dataset", "SELECT c_custkey::VARCHAR AS session_id, 'EMPTY_DATASET' AS code FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def v8(spark, d):
    files = table(spark, d, "customer").selectExpr("CAST(c_custkey AS STRING) AS session_id", "'f' AS file")
    records = table(spark, d, "orders").where("o_orderstatus = 'P'").selectExpr("CAST(o_custkey AS STRING) AS session_id", "'f' AS file")
    return va.empty_dataset(files, records).select("session_id", "code")


@query("v9_metadata_requirement", "SELECT c_custkey::VARCHAR AS session_id, 'METADATA_REQUIREMENT_NOT_MET' AS code FROM customer WHERE c_custkey % 3 = 1")
def v9(spark, d):
    files = table(spark, d, "customer").selectExpr("CAST(c_custkey AS STRING) AS session_id", "'f' AS file", "'imu' AS sensor_type", "CASE c_custkey % 3 WHEN 0 THEN 'imu' WHEN 1 THEN 'gps' END AS source_type")
    return va.metadata_requirement(files).select("session_id", "code")


@query("v10_cap_issues", "SELECT o_custkey::VARCHAR AS session_id, o_orderkey AS record, position, total, total > 3 AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders) WHERE position <= 3")
def v10(spark, d):
    issues = table(spark, d, "orders").selectExpr("CAST(o_custkey AS STRING) AS session_id", "'f' AS file", "o_orderkey AS record", "'x' AS field", "'c' AS code")
    return va.cap_issues(issues, 3).select("session_id", "record", F.col("position").cast("long").alias("position"), "total", "truncated")


_BAD = "(trim(accel_x) = '' OR try_cast(accel_x AS DOUBLE) IS NULL)"


@query("v10_encounter_order", JSON_SQL + " SELECT session_id, string_agg(record || code, ',' ORDER BY record, seq) AS first FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY record, seq) AS position FROM (SELECT session_id, record_number AS record, unnest(CASE WHEN NOT ok THEN ['INVALID_RECORD'] ELSE list_filter([CASE WHEN event_id % 59 = 0 THEN 'MISSING_REQUIRED_FIELD' END, CASE WHEN event_id % 57 = 0 THEN 'UNEXPECTED_FIELD' END, CASE WHEN event_id % 41 = 0 THEN 'INVALID_TYPE' WHEN event_id % 43 = 0 THEN 'INVALID_TIMESTAMP' END, CASE WHEN event_id % 59 <> 0 AND event_id % 51 = 0 THEN 'INVALID_TYPE' END, CASE WHEN event_id % 49 = 0 THEN 'INVALID_TYPE' END, CASE WHEN event_id % 45 = 0 THEN 'NULL_NOT_ALLOWED' END], lambda x: x IS NOT NULL) END) AS code, unnest(range(CASE WHEN NOT ok THEN 1 ELSE (event_id % 59 = 0)::INT + (event_id % 57 = 0)::INT + (event_id % 41 = 0 OR event_id % 43 = 0)::INT + (event_id % 59 <> 0 AND event_id % 51 = 0)::INT + (event_id % 49 = 0)::INT + (event_id % 45 = 0)::INT END)) AS seq FROM lines)) WHERE position <= 5 GROUP BY session_id")
def v10_order(spark, d):
    first = va.cap_issues(va.validate_json(json_lines(spark, d), IMU), 5)
    rows = first.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("position", F.concat("record", "code").alias("x")))).alias("a"))
    return rows.select("session_id", F.array_join(F.transform("a", lambda r: r["x"]), ",").alias("first"))


@query("v11_validation_summary", DIRTY_SQL + f" SELECT session_id, file, count(*) AS records_checked, count(*) FILTER ({_BAD} OR timestamp NOT LIKE '%Z') AS invalid_records, (count(*) FILTER ({_BAD}) + count(*) FILTER (timestamp NOT LIKE '%Z')) AS error_count, CASE WHEN count(*) FILTER ({_BAD} OR timestamp NOT LIKE '%Z') > 0 THEN 'failed' ELSE 'passed' END AS status FROM dirty GROUP BY ALL")
def v11(spark, d):
    df = text_columns(dirty(spark, d))
    return va.validation_counts(df, va.null_checks(df, IMU) + va.text_checks(df, IMU)).select("session_id", "file", "records_checked", "invalid_records", "error_count", "status")


@query("v11_summary_of_issues", DIRTY_SQL + f" SELECT session_id, count(*) AS records_checked, count(*) FILTER ({_BAD} OR timestamp NOT LIKE '%Z') AS invalid_records, CASE WHEN count(*) FILTER ({_BAD} OR timestamp NOT LIKE '%Z') > 0 THEN 'failed' ELSE 'passed' END AS status FROM dirty GROUP BY ALL")
def v11_issues(spark, d):
    df = text_columns(dirty(spark, d))
    return va.validation_summary(df, va.validate_text(df, IMU)).select("session_id", "records_checked", "invalid_records", "status")


@query("v12_latest_report", "SELECT o_custkey AS file_id, o_orderpriority AS schema_name, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS report_id FROM orders GROUP BY ALL")
def v12(spark, d):
    reports = table(spark, d, "orders").selectExpr("o_custkey AS file_id", "o_orderpriority AS schema_name", "'1.0.0' AS schema_version", "'s' AS sha256", "o_orderdate AS validated_at", "o_orderkey AS report_id", "o_orderstatus AS status")
    return va.latest_matching_report(reports).select("file_id", "schema_name", "status", "report_id")


def typed(spark, d):
    df = dirty(spark, d)
    return df.select("session_id", "stream", "record_number", F.unix_micros(tx.to_time(F.col("timestamp"))).alias("epoch_us"), *(tx.to_double(F.col(c)).alias(c) for c in ("accel_x", "accel_y", "accel_z", "gyro_x")))


def integrity_of(spark, d, checks):
    return ig.check_integrity(typed(spark, d), IMU, checks=checks).select("session_id", "record", "field", "code", "severity")


def _issue_sql(field, code, severity, where):
    return DIRTY_SQL + f" SELECT session_id, record_number AS record, '{field}' AS field, '{code}' AS code, '{severity}' AS severity FROM typed WHERE {where}"


@query("c1_non_finite", _issue_sql("accel_x", "NON_FINITE_VALUE", "error", "isnan(ax)"))
def c1(spark, d):
    return integrity_of(spark, d, ig.non_finite(["accel_x", "gyro_x"]))


def gps_checks(spark, d, checks):
    df = sensor(spark, d, "gps").withColumns({"latitude": F.col("latitude") * 1.2, "longitude": F.col("longitude") * 1.1, "speed": F.col("speed") - 3, "stream": F.lit("gps")})
    return ig.check_integrity(df, GPS, checks=checks).select("session_id", "record", "field", "code")


@query("c2_lat_lon_range", SENSORS_SQL + " SELECT session_id, record_number AS record, 'latitude' AS field, 'GPS_LATITUDE_OUT_OF_RANGE' AS code FROM gps WHERE abs(latitude * 1.2::DOUBLE) > 90 UNION ALL SELECT session_id, record_number, 'longitude', 'GPS_LONGITUDE_OUT_OF_RANGE' FROM gps WHERE abs(longitude * 1.1::DOUBLE) > 180")
def c2(spark, d):
    return gps_checks(spark, d, ig.lat_lon_range())


@query("c3_negative_speed", SENSORS_SQL + " SELECT session_id, record_number AS record, 'speed' AS field, 'GPS_NEGATIVE_SPEED' AS code FROM gps WHERE speed - 3 < 0")
def c3(spark, d):
    return gps_checks(spark, d, ig.negative_speed())


@query("c4_imu_extreme", _issue_sql("accel_x", "IMU_ACCELERATION_EXTREME", "warning", "NOT isnan(ax) AND abs(ax) > 200") + " UNION ALL SELECT session_id, record_number, 'gyro_x', 'IMU_GYRO_EXTREME', 'warning' FROM typed WHERE abs(gx) > 50")
def c4(spark, d):
    return integrity_of(spark, d, ig.extremes({c: IMU.limits[c] for c in ("accel_x", "gyro_x")}))


@query("c5_force_torque_extreme", SENSORS_SQL + " SELECT session_id, record_number AS record, 'force_x' AS field, 'FORCE_TORQUE_FORCE_EXTREME' AS code FROM force_torque WHERE abs(force_x) > 40")
def c5(spark, d):
    df = sensor(spark, d, "force_torque").withColumn("stream", F.lit("force_torque"))
    return ig.check_integrity(df, IMU, checks=ig.extremes({"force_x": 40.0, "force_y": None})).select("session_id", "record", "field", "code")


_PREVIOUS = DIRTY_SQL + ", p AS (SELECT *, last_value(epoch_us IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY record_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_us FROM typed)"


@query("c6_timestamp_out_of_order", _PREVIOUS + " SELECT session_id, record_number AS record, 'timestamp' AS field, 'TIMESTAMP_OUT_OF_ORDER' AS code, 'error' AS severity FROM p WHERE epoch_us < previous_us")
def c6(spark, d):
    return integrity_of(spark, d, ig.time_order()[:1])


@query("c7_duplicate_timestamp", _PREVIOUS + " SELECT session_id, record_number AS record, 'timestamp' AS field, 'DUPLICATE_TIMESTAMP' AS code, 'warning' AS severity FROM p WHERE epoch_us = previous_us")
def c7(spark, d):
    return integrity_of(spark, d, ig.time_order()[1:])


@query(
    "c8_integrity_summary",
    _PREVIOUS
    + """, e AS (SELECT session_id, (ax IS NOT NULL AND isnan(ax))::INT + (epoch_us < previous_us IS TRUE)::INT AS e, (NOT isnan(ax) AND abs(ax) > 200 IS TRUE)::INT + (abs(gx) > 50)::INT + (epoch_us = previous_us IS TRUE)::INT AS w FROM (SELECT * REPLACE (coalesce(ax, 0) AS ax) FROM p))
 SELECT session_id, count(*) AS records_checked, sum(e)::BIGINT AS error_count, sum(w)::BIGINT AS warning_count, count(*) FILTER (e > 0) AS failed_records, CASE WHEN sum(e) > 0 THEN 'failed' WHEN sum(w) > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS status FROM e GROUP BY session_id""",
)
def c8(spark, d):
    df = typed(spark, d)
    checks = ig.non_finite(["accel_x"]) + ig.extremes({"accel_x": 200.0, "gyro_x": 50.0}) + ig.time_order()
    return ig.integrity_counts(df, IMU, checks=checks).select("session_id", "records_checked", "error_count", "warning_count", "failed_records", "status")


@query("c8_empty_source", "WITH s AS (SELECT DISTINCT c_custkey AS k FROM customer), n AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) SELECT s.k::VARCHAR AS session_id, coalesce(n, 0) AS records_checked, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS error_count, 0 AS failed_records, CASE WHEN n IS NULL THEN 'failed' ELSE 'passed' END AS status FROM s LEFT JOIN n USING (k)")
def c8_empty(spark, d):
    keys = lambda df, c: df.selectExpr(f"CAST({c} AS STRING) AS session_id", "'imu' AS stream")
    records = keys(table(spark, d, "orders").where("o_orderstatus = 'P'"), "o_custkey")
    none = spark.createDataFrame([], "session_id string, stream string, record long, field string, code string, severity string")
    return ig.integrity_summary(records, none, sources=keys(table(spark, d, "customer"), "c_custkey")).select("session_id", "records_checked", "error_count", "failed_records", "status")


def renamed(spark, d):
    return text_columns(dirty(spark, d)).withColumnsRenamed({"accel_x": "ax", "accel_y": "Accel Y", "gyro_x": "gx"})


@query("n1_resolve_aliases", DIRTY_SQL + " SELECT session_id, record_number, accel_x, accel_y, gyro_x FROM dirty")
def n1(spark, d):
    return nz.resolve_aliases(renamed(spark, d), IMU).select("session_id", "record_number", "accel_x", "accel_y", "gyro_x")


@query("n1_alias_conflicts", "SELECT event_id, 'accel_x' AS field FROM events WHERE event_type = 'view' AND event_id % 3 = 0 UNION ALL SELECT event_id, 'gyro_z' FROM events WHERE event_type = 'view' AND event_id % 5 = 0")
def n1_conflicts(spark, d):
    events = table(spark, d, "events").where("event_type = 'view'")
    lines = events.selectExpr("event_id", """concat('{"ax":1', CASE WHEN event_id % 3 = 0 THEN ',"accel_x":2' ELSE '' END, ',"gz":1', CASE WHEN event_id % 5 = 0 THEN ',"Gyro Z":2,"gyro_z":3' ELSE '' END, '}') AS value""")
    return nz.alias_conflicts(lines, IMU).select("event_id", "field")


@query("n2_convert_units", SENSORS_SQL + f" SELECT session_id, record_number, round(accel_x * {G}::DOUBLE, 9) AS accel_x, round(gyro_x * {DEG}::DOUBLE, 9) AS gyro_x FROM imu")
def n2(spark, d):
    return nz.convert_units(sensor(spark, d, "imu"), IMU, UNITS).select("session_id", "record_number", F.round("accel_x", 9).alias("accel_x"), F.round("gyro_x", 9).alias("gyro_x"))


@query("n3_canonical_timestamp", DIRTY_SQL + " SELECT session_id, record_number, CASE WHEN epoch_us % 1000000 = 0 THEN left(timestamp, 19) || 'Z' WHEN epoch_us IS NOT NULL THEN timestamp END AS timestamp, epoch_us FROM typed")
def n3(spark, d):
    shifted = dirty(spark, d).withColumn("timestamp", F.regexp_replace("timestamp", "Z$", "+00:00"))
    return nz.canonical_timestamp(shifted).select("session_id", "record_number", "timestamp", "epoch_us")


@query("n4_cast_plain", DIRTY_SQL + " SELECT session_id, record_number, CASE WHEN trim(accel_x) <> '' AND (ax IS NULL OR isnan(ax)) THEN 'accel_x' END AS bad_field FROM typed WHERE timestamp LIKE '%Z' AND trim(accel_x) <> ''")
def n4(spark, d):
    df = text_columns(dirty(spark, d)).where("timestamp LIKE '%Z' AND trim(accel_x) <> ''")
    return df.select("session_id", "record_number", nz.cast_failure(IMU, df.columns).alias("bad_field"))


@query("n5_require_non_null", DIRTY_SQL + " SELECT session_id, record_number, 'accel_x' AS bad_field FROM dirty WHERE trim(accel_x) = '' AND timestamp LIKE '%Z'")
def n5(spark, d):
    _, bad = nz.quarantine(text_columns(dirty(spark, d)), IMU)
    return bad.where("trim(accel_x) = '' AND timestamp LIKE '%Z'").select("session_id", "record_number", "bad_field")


@query("n6_project_canonical", DIRTY_SQL + " SELECT session_id, record_number, timestamp, ax AS accel_x, gx AS gyro_x, NULL::VARCHAR AS device_id FROM typed WHERE ax IS NOT NULL AND NOT isnan(ax)")
def n6(spark, d):
    df = dirty(spark, d).withColumn("extra", F.lit(1))
    good = df.where(tx.is_finite(tx.to_double(F.col("accel_x"))))
    return nz.cast_plain(good, IMU).select("session_id", "record_number", "timestamp", "accel_x", "gyro_x", "device_id")


@query("n7_normalize", DIRTY_SQL + f" SELECT session_id, record_number, epoch_us, round(ax * {G}::DOUBLE, 6) AS accel_x, round(gx * {DEG}::DOUBLE, 6) AS gyro_x FROM typed WHERE epoch_us IS NOT NULL AND ax IS NOT NULL AND NOT isnan(ax)")
def n7(spark, d):
    good, _ = nz.normalize(renamed(spark, d), IMU, UNITS, on_error="quarantine")
    return good.select("session_id", "record_number", "epoch_us", F.round("accel_x", 6).alias("accel_x"), F.round("gyro_x", 6).alias("gyro_x"))


@query("n7_gate", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NOT_VALIDATED' WHEN c_custkey % 7 = 0 THEN 'VALIDATION_FAILED' WHEN c_custkey % 3 = 0 THEN 'NOT_CHECKED' WHEN c_custkey % 11 = 0 THEN 'INTEGRITY_FAILED' END AS refused FROM customer")
def n7_gate(spark, d):
    files = table(spark, d, "customer").selectExpr("c_custkey", "CAST(c_custkey AS STRING) AS file_id", "'imu' AS schema_name", "'1.0.0' AS schema_version", "'now' AS sha256")
    keys = ["file_id", "schema_name", "schema_version"]
    report = lambda where, status, time, sha="now": files.where(where).select(*keys, F.lit(sha).alias("sha256"), F.expr(status).alias("status"), F.lit(time).alias("validated_at"), F.lit(time).alias("created_at"), F.lit("r").alias("report_id"))
    validations = report("c_custkey % 5 <> 0", "CASE WHEN c_custkey % 7 = 0 THEN 'failed' ELSE 'passed' END", 2).unionByName(report("true", "'failed'", 1, "old")).unionByName(report("c_custkey % 5 <> 0", "'failed'", 1))
    integrities = report("c_custkey % 3 <> 0", "CASE WHEN c_custkey % 11 = 0 THEN 'failed' ELSE 'passed_with_warnings' END", 3)
    return nz.gate(files, validations, integrities).select("c_custkey", "refused")
