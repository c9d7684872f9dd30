"""Normalization (N1 to N7): aliases, units, canonical time, types, canonical order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.storage import materialize
from ..specs import UNITS, SensorSpec


def resolve_aliases(df: DataFrame, spec: SensorSpec) -> DataFrame:
    """The explicit names only; two names of one field are an error."""
    target = [spec.aliases.get(c, c) for c in df.columns]
    twice = {t for t in target if target.count(t) > 1}
    if twice:
        raise ValueError(f"several input columns mean {', '.join(sorted(twice))}")
    return df.toDF(*target)


def alias_conflicts(records: DataFrame, spec: SensorSpec, value: str = "value") -> DataFrame:
    """N1 of JSON: (the columns of `records` and field) where one record gives a field under several names; such a run fails."""
    own = F.map_keys(F.from_json(value, "map<string,string>"))
    names = {f: [f, *(a for a, t in spec.aliases.items() if t == f)] for f in spec.fields}
    twice = [F.when(F.size(F.array_intersect(own, F.array(*map(F.lit, n)))) > 1, f) for f, n in names.items()]
    return records.withColumn("field", F.explode(F.filter(F.array(*twice), lambda x: x.isNotNull())))


def unit_factors(spec: SensorSpec, units: dict[str, str]) -> dict[str, float]:
    """Field to factor; every dimension of the sensor needs a supported unit before anything is read."""
    out = {}
    for dimension, fields in spec.dimensions.items():
        if units.get(dimension) not in UNITS[dimension]:
            raise ValueError(f"{dimension}: {units.get(dimension)!r} is no supported unit")
        out |= dict.fromkeys(fields, UNITS[dimension][units[dimension]])
    return out


def convert_units(df: DataFrame, spec: SensorSpec, units: dict[str, str]) -> DataFrame:
    """N2."""
    return df.withColumns({c: F.col(c) * F.lit(f) for c, f in unit_factors(spec, units).items() if c in df.columns and f != 1.0})


def canonical_timestamp(df: DataFrame, column: str = "timestamp", ts: Column | None = None) -> DataFrame:
    """UTC text, and epoch_us; ts: the time converted before."""
    ts = tx.to_time(F.col(column)) if ts is None else ts
    return df.withColumns({"epoch_us": F.unix_micros(ts), column: tx.iso_utc(ts)})


def cast_failure(spec: SensorSpec, columns: list[str], typed: dict[str, Column] | None = None) -> Column:
    """First field of a text record that N3, N4 or N5 refuse, or null; typed: values cast before, by field."""
    out = []
    for n, f in spec.fields.items():
        c = F.col(n) if n in columns else F.lit(None).cast("string")
        value = tx.CASTS[f.type](c) if typed is None else typed[n]
        bad = ~tx.blank(c) & (value.isNull() | (~tx.is_finite(value) if f.type == "float" else F.lit(False)))
        if not f.nullable:
            bad = bad | tx.blank(c)
        out.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(n)))
    return F.coalesce(*out)


def with_values(df: DataFrame, spec: SensorSpec) -> tuple[DataFrame, dict[str, Column]]:
    """The fields of `spec` cast once, in a struct beside the text."""
    if "_values" in df.columns:
        return df, {n: F.col(f"_values.{n}") for n in spec.fields}
    cells = [tx.CASTS[f.type](F.col(n) if n in df.columns else F.lit(None).cast("string")).alias(n) for n, f in spec.fields.items()]
    return df.withColumn("_values", F.struct(*cells)), {n: F.col(f"_values.{n}") for n in spec.fields}


def typed_table(df: DataFrame, spec: SensorSpec) -> DataFrame:
    """The text records under canonical names with `_values`, all fields converted once, written once.

    Validation, integrity (`measured`) and normalization all read this table and none converts again.
    """
    return materialize(with_values(resolve_aliases(df, spec), spec)[0], "typed")


def measured(typed: DataFrame, spec: SensorSpec, keys: tuple[str, ...] = ("session_id", "stream")) -> DataFrame:
    """What integrity checks read of a typed table: keys, record_number, epoch_us and the numbers."""
    numbers = [F.col(f"_values.{n}").alias(n) for n in spec.of_type("float", "integer") if n in typed.columns]
    return typed.select(*keys, "record_number", F.unix_micros("_values.timestamp").alias("epoch_us"), *numbers)


def cast_plain(df: DataFrame, spec: SensorSpec, typed: dict[str, Column] | None = None, time: Column | None = None) -> DataFrame:
    """Typed fields in canonical order after the other columns; blanks of optional fields are null.

    A `time` converted before stays as column `_time`.
    """
    values = {}
    for n, f in spec.fields.items():
        c = F.col(n) if n in df.columns else F.lit(None).cast("string")
        values[n] = F.when(~tx.blank(c), c if f.type == "datetime" else tx.CASTS[f.type](c) if typed is None else typed[n])
    rest = [c for c in df.columns if c in ("session_id", "stream", "file", "record_number")]
    return df.select(*rest, *(v.alias(n) for n, v in values.items()), *([] if time is None else [time.alias("_time")]))


def quarantine(df: DataFrame, spec: SensorSpec) -> tuple[DataFrame, DataFrame]:
    """Records that can be normalized, and the others with the field that is to blame."""
    marked = df.withColumn("bad_field", cast_failure(spec, df.columns))
    return marked.where("bad_field is null").drop("bad_field"), marked.where("bad_field is not null")


def normalize(df: DataFrame, spec: SensorSpec, units: dict[str, str], on_error: str = "fail"):
    """One lazy projection.  `fail` raises at the first bad record when run; `quarantine` returns (good, bad)."""
    named = resolve_aliases(df, spec)
    unit_factors(spec, units)
    held, typed = with_values(named, spec)
    bad = cast_failure(spec, named.columns, typed)
    ready = lambda rows: convert_units(canonical_timestamp(cast_plain(rows, spec, typed, typed["timestamp"]), ts=F.col("_time")).drop("_time"), spec, units)
    if on_error == "quarantine":
        marked = held.withColumn("bad_field", bad)
        return ready(marked.where("bad_field is null")), marked.where("bad_field is not null").drop("_values")
    checked = held.withColumn("record_number", F.when(bad.isNull(), F.col("record_number")).otherwise(F.raise_error(F.concat(F.lit("record "), F.col("record_number").cast("string"), F.lit(": bad "), bad)).cast("long")))
    return ready(checked)


def gate(files: DataFrame, validations: DataFrame, integrities: DataFrame) -> DataFrame:
    """Adds `refused`, why a file (file_id, schema_name, schema_version, sha256) may not be normalized, or null.

    The newest validation report of the same file, schema and content has to have passed, and the
    newest integrity report (times in validated_at and created_at) has to have passed, warnings allowed.
    """
    keys = ["file_id", "schema_name", "schema_version", "sha256"]
    newest = lambda df, time, name: df.groupBy(*keys).agg(F.max_by("status", F.struct(time, "report_id")).alias(name))
    out = files.join(newest(validations, "validated_at", "_v"), keys, "left").join(newest(integrities, "created_at", "_i"), keys, "left")
    why = F.when(F.col("_v").isNull(), "NOT_VALIDATED").when(F.col("_v") != "passed", "VALIDATION_FAILED").when(F.col("_i").isNull(), "NOT_CHECKED").when(F.col("_i") == "failed", "INTEGRITY_FAILED")
    return out.withColumn("refused", why).drop("_v", "_i")
