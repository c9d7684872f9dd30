"""Plausibility checks (C1 to C8): records to issues with a severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import last_before
from ..functions.text import is_finite
from ..specs import SensorSpec

KEYS = ["session_id", "stream"]
# Code of a magnitude over its limit, by the start of the field's name.
EXTREMES = {"accel_": "IMU_ACCELERATION_EXTREME", "gyro_": "IMU_GYRO_EXTREME", "force_": "FORCE_TORQUE_FORCE_EXTREME", "torque_": "FORCE_TORQUE_TORQUE_EXTREME"}


def found(field: str, code: str, severity: str) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(severity).alias("severity"))


def non_finite(fields: list[str]) -> list[Column]:
    """C1."""
    return [F.when(F.col(c).isNotNull() & ~is_finite(F.col(c)), found(c, "NON_FINITE_VALUE", "error")) for c in fields]


def lat_lon_range() -> list[Column]:
    """C2; a value that isn't finite is C1's matter."""
    return [F.when(is_finite(F.col(c)) & ~F.col(c).between(-b, b), found(c, code, "error")) for c, b, code in (("latitude", 90.0, "GPS_LATITUDE_OUT_OF_RANGE"), ("longitude", 180.0, "GPS_LONGITUDE_OUT_OF_RANGE"))]


def negative_speed() -> list[Column]:
    """C3."""
    return [F.when(is_finite(F.col("speed")) & (F.col("speed") < 0), found("speed", "GPS_NEGATIVE_SPEED", "error"))]


def extremes(limits: dict[str, float | None]) -> list[Column]:
    """Magnitudes over a limit are warnings; no limit, no check."""
    code = lambda c: next(v for k, v in EXTREMES.items() if c.startswith(k))
    return [F.when(is_finite(F.col(c)) & (F.abs(c) > v), found(c, code(c), "warning")) for c, v in limits.items() if v is not None]


def with_previous_time(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Adds `previous_us`, the last time before the record that could be read; sessions are cut into blocks."""
    return last_before(df, keys, "record_number", "epoch_us", "previous_us")


def time_order() -> list[Column]:
    """C6, C7, against the record before (not the running maximum)."""
    return [
        F.when(F.col("epoch_us") < F.col("previous_us"), found("timestamp", "TIMESTAMP_OUT_OF_ORDER", "error")),
        F.when(F.col("epoch_us") == F.col("previous_us"), found("timestamp", "DUPLICATE_TIMESTAMP", "warning")),
    ]


def checks_for(spec: SensorSpec) -> list[Column]:
    out = non_finite(spec.of_type("float", "integer"))
    if spec.name == "gps":
        out += lat_lon_range() + negative_speed()
    return out + extremes(spec.limits) + time_order()


def check_integrity(df: DataFrame, spec: SensorSpec, keys: list[str] = KEYS, checks: list[Column] | None = None) -> DataFrame:
    """One row per issue: keys, record, field, code, severity.  df: keys, record_number, epoch_us and typed fields."""
    ready = with_previous_time(df, keys)
    array = F.filter(F.array(*(checks_for(spec) if checks is None else checks)), lambda x: x.isNotNull())
    return ready.select(*keys, F.col("record_number").alias("record"), F.explode(array).alias("i")).select(*keys, "record", "i.*")


def empty_sources(sources: DataFrame, records: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """An issue, without a record, for each of the `sources` (rows of keys) that has no records."""
    none = sources.select(*keys).distinct().join(records.select(*keys).distinct(), keys, "left_anti")
    return none.select(*keys, F.lit(None).cast("long").alias("record"), F.lit(None).cast("string").alias("field"), F.lit("EMPTY_DATASET").alias("code"), F.lit("error").alias("severity"))


def integrity_summary(records: DataFrame, issues: DataFrame, keys: list[str] = KEYS, sources: DataFrame | None = None) -> DataFrame:
    """Counts and status; warnings don't fail a record.  With `sources`, one without records counts an error."""
    if sources is not None:
        issues = issues.unionByName(empty_sources(sources, records, keys))
    per = issues.groupBy(*keys, "record").agg(F.sum((F.col("severity") == "error").cast("long")).alias("e"), F.sum((F.col("severity") == "warning").cast("long")).alias("w"))
    totals = per.groupBy(*keys).agg(F.sum("e").alias("error_count"), F.sum("w").alias("warning_count"), F.sum(((F.col("e") > 0) & F.col("record").isNotNull()).cast("long")).alias("failed_records"))
    out = records.groupBy(*keys).agg(F.count("*").alias("records_checked")).join(totals, keys, "full").na.fill(0, ["records_checked", "error_count", "warning_count", "failed_records"])
    return with_status(out)


def integrity_counts(df: DataFrame, spec: SensorSpec, keys: list[str] = KEYS, checks: list[Column] | None = None) -> DataFrame:
    """C8 in one pass over the records: what `integrity_summary` gives for the issues of these checks."""
    severities = [c["severity"] for c in (checks_for(spec) if checks is None else checks)]
    # plain sums stay in generated code, arrays of issues don't
    number = lambda kind: sum((F.coalesce(s == kind, F.lit(False)).cast("int") for s in severities), F.lit(0))
    each = with_previous_time(df, keys).select(*keys, number("error").alias("e"), number("warning").alias("w"))
    return with_status(each.groupBy(*keys).agg(F.count("*").alias("records_checked"), F.sum("e").alias("error_count"), F.sum("w").alias("warning_count"), F.sum((F.col("e") > 0).cast("long")).alias("failed_records")))


def with_status(out: DataFrame) -> DataFrame:
    status = F.when((F.col("error_count") > 0) | (F.col("records_checked") == 0), "failed").when(F.col("warning_count") > 0, "passed_with_warnings").otherwise("passed")
    return out.withColumn("passed_records", F.col("records_checked") - F.col("failed_records")).withColumn("status", status)
