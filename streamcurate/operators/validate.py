"""Structural validation: records to issues.

All checks of a record are one array of issues built by column expressions and exploded once, so a
file is read once however many checks run.  Issue rows: the key columns, record, field, code, message, seq.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..specs import SensorSpec

FILE = ["session_id", "file"]
ISSUE = "struct<field:string,code:string,message:string>"
MOST = 1000
#: `seq` is the place of an issue among those of its record: names of fields come first, then their values.
AFTER_KEYS = 100_000


def issue(field, code: str, message: str) -> Column:
    return F.struct((F.lit(field) if isinstance(field, str) else field).alias("field"), F.lit(code).alias("code"), F.lit(message).alias("message"))


def gathered(df: DataFrame, checks: list[Column], keys: list[str]) -> DataFrame:
    """One row per issue of each record; `checks` are issue structs or null."""
    found = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast(f"array<{ISSUE}>")
    each = df.select(*keys, F.col("record_number").alias("record"), F.posexplode(found).alias("seq", "i"))
    return each.select(*keys, "record", "i.field", "i.code", "i.message", (F.col("seq") + AFTER_KEYS).alias("seq"))


def header_issues(headers: DataFrame, spec: SensorSpec, keys: list[str] = FILE) -> DataFrame:
    """V1, V2 of CSV: once per file against its header (column `header`: array of names), record null."""
    known, needed = list(spec.fields), [n for n, f in spec.fields.items() if f.required]
    return _absent_and_extra(headers, F.col("header"), needed, known, spec.allow_extra, keys, F.lit(None).cast("long"))


def key_issues(records: DataFrame, spec: SensorSpec, keys: list[str] = FILE) -> DataFrame:
    """V1, V2 of JSON: once per record against its keys (column `value`: the JSON text)."""
    known, needed = list(spec.fields), [n for n, f in spec.fields.items() if f.required]
    own = F.map_keys(F.from_json("value", "map<string,string>"))
    return _absent_and_extra(records.where(is_object("value")), own, needed, known, spec.allow_extra, keys, F.col("record_number"))


def _absent_and_extra(df, own, needed, known, allow_extra, keys, record):
    names = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    absent = F.transform(F.array_except(names(needed), own), lambda f: issue(f, "MISSING_REQUIRED_FIELD", "required field is absent"))
    extra = F.transform(F.array_except(own, names(known)), lambda f: issue(f, "UNEXPECTED_FIELD", "field is not in the schema"))
    both = absent if allow_extra else F.concat(absent, extra)
    return df.select(*keys, record.alias("record"), F.posexplode(both).alias("seq", "i")).select(*keys, "record", "i.field", "i.code", "i.message", "seq")


def null_checks(df: DataFrame, spec: SensorSpec) -> list[Column]:
    """V3 of CSV: a null or blank value of a field that may not be null."""
    return [F.when(tx.blank(F.col(n)), issue(n, "NULL_NOT_ALLOWED", "value is null or blank")) for n, f in spec.fields.items() if not f.nullable and n in df.columns]


def text_checks(df: DataFrame, spec: SensorSpec) -> list[Column]:
    """V4, V6 of CSV: text that doesn't convert to the declared type; blanks are V3's matter.

    Values that `normalize.typed_table` has converted before aren't converted again.
    """
    out = []
    value = lambda n, f: F.col(f"_values.{n}") if "_values" in df.columns else tx.CASTS[f.type](F.col(n))
    for n, f in spec.fields.items():
        if n in df.columns and f.type != "string":
            code, message = ("INVALID_TIMESTAMP", "not ISO-8601 with an offset") if f.type == "datetime" else ("INVALID_TYPE", f"not a valid {f.type}")
            out.append(F.when(~tx.blank(F.col(n)) & value(n, f).isNull(), issue(n, code, message)))
    return out


def validate_text(df: DataFrame, spec: SensorSpec, keys: list[str] = FILE) -> DataFrame:
    """V3, V4 and V6 over text records."""
    return gathered(df, null_checks(df, spec) + text_checks(df, spec), keys)


def plain_numbers(value: str) -> Column:
    """JSON text with bare NaN and Infinity tokens as strings, which only then is legal JSON."""
    return F.regexp_replace(F.col(value), r'(?<=[:\[,])\s*(NaN|-?Infinity)\s*(?=[,}\]])', '"$1"')


def is_object(value: str) -> Column:
    kind = F.schema_of_variant(F.try_parse_json(plain_numbers(value)))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def native_checks(spec: SensorSpec, value: str = "value") -> list[Column]:
    """V3, V5, V6 of JSON: types of the values that are there; absent keys are V1's matter."""
    record = F.try_parse_json(plain_numbers(value))
    out = []
    for n, f in spec.fields.items():
        part = F.try_variant_get(record, f"$.{n}", "variant")
        kind = F.schema_of_variant(part)
        null = F.is_variant_null(part)
        if not f.nullable:
            out.append(F.when(null, issue(n, "NULL_NOT_ALLOWED", "value is null")))
        number = (kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE") | (kind == "FLOAT")
        token = (kind == "STRING") & F.try_variant_get(record, f"$.{n}", "string").isin("NaN", "Infinity", "-Infinity")
        right = {"float": number | token, "integer": kind == "BIGINT", "boolean": kind == "BOOLEAN", "string": kind == "STRING", "datetime": kind == "STRING"}[f.type]
        out.append(F.when(part.isNotNull() & ~null & ~right, issue(n, "INVALID_TYPE", f"not a JSON {f.type}")))
        if f.type == "datetime":
            wrong = (kind == "STRING") & tx.to_time(F.try_variant_get(record, f"$.{n}", "string")).isNull()
            out.append(F.when(wrong, issue(n, "INVALID_TIMESTAMP", "not ISO-8601 with an offset")))
    return out


def validate_json(df: DataFrame, spec: SensorSpec, keys: list[str] = FILE) -> DataFrame:
    """V1 to V3, V5 to V7 over JSON lines (column `value`)."""
    good = df.where(is_object("value"))
    return invalid_json(df, keys).unionByName(key_issues(df, spec, keys)).unionByName(gathered(good, native_checks(spec), keys))


def invalid_json(df: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """V7 of JSON lines: malformed, or no object."""
    check = F.when(~is_object("value"), issue(F.lit(None).cast("string"), "INVALID_RECORD", "not a JSON object"))
    return gathered(df.where(F.trim("value") != ""), [check], keys)


def invalid_csv(records: DataFrame, headers: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """V7 of CSV: records (column `cells`) with more cells than their file's header, or too long to be taken apart (null)."""
    wide = F.coalesce(F.size("cells") > F.size("header"), F.lit(False))
    none = F.lit(None).cast("string")
    checks = [F.when(F.col("cells").isNull(), issue(none, "INVALID_RECORD", "record is too long")), F.when(wide, issue(none, "INVALID_RECORD", "more cells than the header"))]
    return gathered(records.join(headers, [k for k in keys if k in headers.columns], "left"), checks, keys)


def empty_dataset(files: DataFrame, records: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """V8: one error for each file without records."""
    none = files.join(records.select(*keys).distinct(), keys, "left_anti")
    return none.select(*keys, F.lit(None).cast("long").alias("record"), F.lit(None).cast("string").alias("field"), F.lit("EMPTY_DATASET").alias("code"), F.lit("file has no records").alias("message"), F.lit(0).alias("seq"))


def metadata_requirement(files: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """V9: the schema's sensor type has to equal the file's source type, where that is set."""
    bad = files.where(F.col("source_type").isNotNull() & (F.col("source_type") != F.col("sensor_type")))
    return bad.select(*keys, F.lit(None).cast("long").alias("record"), F.lit("source_type").alias("field"), F.lit("METADATA_REQUIREMENT_NOT_MET").alias("code"), F.lit("source type differs from the schema's sensor type").alias("message"), F.lit(0).alias("seq"))


def cap_issues(issues: DataFrame, most: int = MOST, keys: list[str] = FILE) -> DataFrame:
    """The first `most` issues of each file in encounter order; total and truncated stay exact."""
    order = Window.partitionBy(*keys).orderBy(F.col("record").asc_nulls_first(), *(["seq"] if "seq" in issues.columns else []), "field", "code")
    # ranking alone lets Spark cut each task's rows first; totals come from a mergeable count
    first = issues.withColumn("position", F.row_number().over(order)).where(F.col("position") <= most)
    totals = issues.groupBy(*keys).agg(F.count("*").alias("total"))
    return first.join(totals, keys).withColumn("truncated", F.col("total") > most)


def validation_summary(records: DataFrame, issues: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Records checked, valid and invalid, errors and status of each file."""
    per_record = issues.groupBy(*keys, "record").agg(F.count("*").alias("n"))
    found = per_record.groupBy(*keys).agg(F.sum("n").alias("error_count"), F.count("record").alias("invalid_records"))
    checked = records.groupBy(*keys).agg(F.count("*").alias("records_checked"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = checked.join(found, keys, "full").select(*keys, zero("records_checked"), zero("invalid_records"), zero("error_count"))
    return out.withColumn("valid_records", F.col("records_checked") - F.col("invalid_records")).withColumn("status", F.when(F.col("error_count") > 0, "failed").otherwise("passed"))


def validation_counts(df: DataFrame, checks: list[Column], keys: list[str] = FILE) -> DataFrame:
    """V11 in one pass over the records: what `validation_summary` gives for the issues of these checks."""
    # plain sums stay in generated code, arrays of issues don't
    found = df.select(*keys, sum((c.isNotNull().cast("int") for c in checks), F.lit(0)).alias("n"))
    out = found.groupBy(*keys).agg(F.count("*").alias("records_checked"), F.sum((F.col("n") > 0).cast("long")).alias("invalid_records"), F.sum("n").alias("error_count"))
    return out.withColumn("valid_records", F.col("records_checked") - F.col("invalid_records")).withColumn("status", F.when(F.col("error_count") > 0, "failed").otherwise("passed"))


def latest_matching_report(reports: DataFrame) -> DataFrame:
    """The newest report of each file, schema and content hash."""
    keys = ["file_id", "schema_name", "schema_version", "sha256"]
    rest = [c for c in reports.columns if c not in keys]
    best = reports.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("validated_at", "report_id")).alias("r"))
    return best.select(*keys, "r.*")
