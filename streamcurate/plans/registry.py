"""Registered queries, and the tables of sensor records they are applied to.

Sensor streams come from `events`: views stand for inertial records, clicks for positions, purchases
for force and torque.  The same views exist as DataFrames and as DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sync
from ..operators import windows as wn

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
HOURS_6_US = 6 * 3600 * 1_000_000


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


SENSOR_COLUMNS = {
    "imu": ("view", ["CAST(value AS DOUBLE) AS accel_x", "value / 2 AS accel_y", "CAST(9.8 AS DOUBLE) AS accel_z", *(f"CAST(event_id % 100 AS DOUBLE) / CAST(10 AS DOUBLE) AS gyro_{a}" for a in "xyz")]),
    "gps": ("click", ["CAST(event_id % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - 90 AS latitude", "CAST(event_id % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - 180 AS longitude", "CAST(value AS DOUBLE) AS altitude", "value / 10 AS speed"]),
    "force_torque": ("purchase", [*(f"value + event_id % 7 AS force_{a}" for a in "xyz"), *(f"value - event_id % 7 AS torque_{a}" for a in "xyz")]),
}


def sensor(spark: SparkSession, d: str, name: str) -> DataFrame:
    kind, columns = SENSOR_COLUMNS[name]
    events = table(spark, d, "events").where(F.col("event_type") == kind)
    return events.selectExpr("CAST(user_id AS STRING) AS session_id", "CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS record_number", "unix_micros(CAST(ts AS TIMESTAMP)) AS epoch_us", "event_id", *columns)


def stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = sensor(spark, d, name)
    return sync.to_stream(df, [c for c in df.columns if c not in ("session_id", "record_number", "epoch_us", "event_id")])


def streams(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: stream(spark, d, n) for n in SENSOR_COLUMNS}


SENSORS_SQL = "WITH RECURSIVE " + ",\n".join(
    f"{n} AS (SELECT user_id::VARCHAR AS session_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS record_number, epoch_us(ts) AS epoch_us, event_id, {', '.join(c)} FROM events WHERE event_type = '{k}')" for n, (k, c) in SENSOR_COLUMNS.items()
)


def asof_sql(target: str, side: str, columns: list[str], name: str) -> str:
    """Two as-of joins: the sample at or before each target, and the first one after."""
    picks = lambda p: ", ".join(f"s.{c} AS {p}_{c}" for c in ["epoch_us", *columns])
    parts = [f"{name}_{p} AS (SELECT t.session_id, t.record_number, t.epoch_us, {picks(p)} FROM {target} t ASOF LEFT JOIN {side} s ON t.session_id = s.session_id AND t.epoch_us {op} s.epoch_us)" for p, op in (("p", ">="), ("n", "<"))]
    use = "p_epoch_us IS NOT NULL AND (n_epoch_us IS NULL OR epoch_us - p_epoch_us <= n_epoch_us - epoch_us)"
    both = f"{name} AS (SELECT *, CASE WHEN {use} THEN epoch_us - p_epoch_us ELSE n_epoch_us - epoch_us END AS near_us, {use} AS use_prev, CASE WHEN p_epoch_us = epoch_us THEN 0 ELSE least(epoch_us - p_epoch_us, n_epoch_us - epoch_us) END AS line_us, (p_epoch_us = epoch_us OR (p_epoch_us IS NOT NULL AND n_epoch_us IS NOT NULL)) IS TRUE AS line_ok FROM {name}_p JOIN {name}_n USING (session_id, record_number, epoch_us))"
    return ",\n".join([*parts, both])


def line_sql(c: str) -> str:
    return f"CASE WHEN p_epoch_us = epoch_us THEN p_{c} WHEN p_epoch_us IS NOT NULL AND n_epoch_us IS NOT NULL THEN p_{c} + (n_{c} - p_{c}) * ((epoch_us - p_epoch_us) / (n_epoch_us - p_epoch_us)) END"


def synced(spark: SparkSession, d: str, bucket_us: int | str | None = "auto") -> DataFrame:
    return sync.synchronize(streams(spark, d), "imu", {"force_torque": "linear"}, tolerance_ms=HOURS_6_US / 1000, bucket_us=bucket_us)


SYNC_SQL = f"""{SENSORS_SQL},
{asof_sql("imu", "gps", ["latitude", "longitude", "altitude", "speed"], "g")},
{asof_sql("imu", "force_torque", ["force_x"], "f")},
gm AS (SELECT session_id, record_number, near_us IS NOT NULL AND near_us <= {HOURS_6_US} AS gps_ok, near_us / 1000.0 AS gps_ms, {", ".join(f"CASE WHEN near_us <= {HOURS_6_US} THEN CASE WHEN use_prev THEN p_{c} ELSE n_{c} END END AS {c}" for c in ("latitude", "longitude", "altitude", "speed"))} FROM g),
fm AS (SELECT session_id, record_number, line_ok AS ft_ok, line_us / 1000.0 AS ft_ms, {line_sql("force_x")} AS force_x FROM f),
rows_ AS (SELECT imu.*, record_number AS row_index, gm.* EXCLUDE (session_id, record_number), fm.* EXCLUDE (session_id, record_number) FROM imu JOIN gm USING (session_id, record_number) JOIN fm USING (session_id, record_number))"""

SIZE, STRIDE = 5, 3
STATS = ("mean", "std", "min", "max", "median", "first", "last", "delta")
FEATURES = {
    "imu": {"fields": ["accel_x", "gyro_x"], "statistics": STATS, "magnitudes": {"accel_magnitude": ("accel_x", "accel_y", "accel_z")}, "raw": True},
    "gps": {"fields": ["altitude"], "statistics": STATS, "displacement": True},
}


def windowed(spark: SparkSession, d: str, drop_incomplete: bool = True) -> DataFrame:
    return wn.count_windows(synced(spark, d), SIZE, STRIDE, drop_incomplete)


def samples(spark: SparkSession, d: str) -> DataFrame:
    return wn.transform(windowed(spark, d), FEATURES)


#: Windows by their definition: rows [k * stride, k * stride + size) of each session, full ones.
WINDOWS_SQL = f"""{SYNC_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY row_index) - 1 AS i, count(*) OVER (PARTITION BY session_id) AS n FROM rows_),
ks AS (SELECT session_id, n, unnest(generate_series(0, CASE WHEN n >= {SIZE} THEN (n - {SIZE}) // {STRIDE} ELSE -1 END)) AS k FROM (SELECT DISTINCT session_id, n FROM numbered)),
w AS (SELECT r.*, ks.k FROM numbered r JOIN ks ON r.session_id = ks.session_id AND r.i >= ks.k * {STRIDE} AND r.i < ks.k * {STRIDE} + {SIZE})"""


def stats_sql(c: str, name: str) -> str:
    first, last = f"arg_min({c}, row_index) FILTER ({c} IS NOT NULL)", f"arg_max({c}, row_index) FILTER ({c} IS NOT NULL)"
    forms = {"mean": f"avg({c})", "std": f"stddev_pop({c})", "min": f"min({c})", "max": f"max({c})", "median": f"median({c})", "first": first, "last": last, "delta": f"{last} - {first}"}
    return ", ".join(f"round({v}, 6) AS {name}_{k}" for k, v in forms.items())


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


#: Raw text records of the inertial sensor with planted faults, the same in both engines.
def dirty(spark: SparkSession, d: str) -> DataFrame:
    return sensor_text(table(spark, d, "events").where("event_type = 'view'"))


def sensor_text(events: DataFrame) -> DataFrame:
    stamp = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || 'Z'"
    back, same = stamp.format("CAST(ts AS TIMESTAMP) - INTERVAL 1000 HOUR"), stamp.format("lag(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY user_id ORDER BY event_id)")
    plain = stamp.format("CAST(ts AS TIMESTAMP)")
    return events.selectExpr(
        "CAST(user_id AS STRING) AS session_id",
        "CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS record_number",
        "event_id",
        f"CASE WHEN event_id % 61 = 0 THEN {back} WHEN event_id % 53 = 0 THEN coalesce({same}, {plain}) WHEN event_id % 47 = 0 THEN left({plain}, 19) ELSE {plain} END AS timestamp",
        "CASE WHEN event_id % 97 = 0 THEN 'abc' WHEN event_id % 89 = 0 THEN ' ' WHEN event_id % 83 = 0 THEN 'nan' WHEN event_id % 79 = 0 THEN '300' ELSE CAST(event_id % 150 AS STRING) || '.5' END AS accel_x",
        "CAST(event_id % 10 AS STRING) AS accel_y",
        "CAST('9.75' AS STRING) AS accel_z",
        "CASE WHEN event_id % 73 = 0 THEN '-60' ELSE CAST(event_id % 40 AS STRING) END AS gyro_x",
    ).withColumn("file", F.concat("session_id", F.lit(".csv"))).withColumn("stream", F.lit("imu"))


def _stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


DIRTY_SQL = f"""WITH dirty AS (SELECT user_id::VARCHAR AS session_id, user_id || '.csv' AS file, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS record_number, event_id, ts,
  CASE WHEN event_id % 61 = 0 THEN {_stamp("ts - INTERVAL 1000 HOUR")} WHEN event_id % 53 = 0 THEN coalesce({_stamp("lag(ts) OVER (PARTITION BY user_id ORDER BY event_id)")}, {_stamp("ts")}) WHEN event_id % 47 = 0 THEN left({_stamp("ts")}, 19) ELSE {_stamp("ts")} END AS timestamp,
  CASE WHEN event_id % 97 = 0 THEN 'abc' WHEN event_id % 89 = 0 THEN ' ' WHEN event_id % 83 = 0 THEN 'nan' WHEN event_id % 79 = 0 THEN '300' ELSE (event_id % 150) || '.5' END AS accel_x,
  (event_id % 10)::VARCHAR AS accel_y, '9.75' AS accel_z, CASE WHEN event_id % 73 = 0 THEN '-60' ELSE (event_id % 40)::VARCHAR END AS gyro_x
  FROM events WHERE event_type = 'view'),
typed AS (SELECT *, CASE WHEN timestamp LIKE '%Z' THEN epoch_us(left(timestamp, 26)::TIMESTAMP) END AS epoch_us, try_cast(nullif(trim(accel_x), '') AS DOUBLE) AS ax, gyro_x::DOUBLE AS gx FROM dirty)"""

#: JSON lines with planted faults.
def json_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where("event_type = 'view'").selectExpr("CAST(user_id AS STRING) AS session_id", "user_id || '.jsonl' AS file", "CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS record_number", f"{_JSON_LINE.format(text='STRING')} AS value")


_JSON_LINE = """CASE WHEN event_id % 71 = 0 THEN '{{broken' WHEN event_id % 67 = 0 THEN '[1,2]' ELSE concat('{{"timestamp":', CASE WHEN event_id % 41 = 0 THEN '5' WHEN event_id % 43 = 0 THEN '"2024-01-01T00:00:00"' ELSE '"2024-01-01T00:00:00Z"' END,
  CASE WHEN event_id % 59 = 0 THEN '' ELSE concat(',"accel_x":', CASE WHEN event_id % 51 = 0 THEN '"text"' ELSE CAST(event_id % 100 AS {text}) END) END,
  ',"accel_y":', CASE WHEN event_id % 49 = 0 THEN 'true' ELSE '1.5' END, ',"accel_z":', CASE WHEN event_id % 45 = 0 THEN 'null' WHEN event_id % 44 = 0 THEN 'NaN' ELSE '9' END, CASE WHEN event_id % 57 = 0 THEN ',"foo":1' ELSE '' END, '}}') END"""
JSON_SQL = f"""WITH lines AS (SELECT user_id::VARCHAR AS session_id, user_id || '.jsonl' AS file, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS record_number, {_JSON_LINE.format(text="VARCHAR")} AS value,
  event_id % 71 <> 0 AND event_id % 67 <> 0 AS ok FROM events WHERE event_type = 'view')"""
