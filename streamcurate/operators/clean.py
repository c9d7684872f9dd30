"""Cleaning (L1 to L8): drop rules in fixed order, exact dedup, redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REASONS = "array<struct<code:string,stream:string>>"
MOST = 1000


def reason(code: str, stream: str | None = None) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(stream).cast("string").alias("stream"))


def required_streams(names: list[str]) -> Column:
    """L1: a reason per required stream that is null, in the given order."""
    return F.filter(F.array(*(F.when(F.col(f"streams.{n}").isNull(), reason("MISSING_REQUIRED_STREAM", n)) for n in names)).cast(REASONS), lambda r: r.isNotNull())


def min_present_streams(known: list[str], least: int) -> Column:
    """L2."""
    present = sum((F.col(f"streams.{n}").isNotNull().cast("int") for n in known), F.lit(0))
    return F.when(present < least, F.array(reason("INSUFFICIENT_MODALITY_COVERAGE")).cast(REASONS))


def all_optional_missing(known: list[str], required: list[str]) -> Column:
    """L3: nothing but required streams left; without optional streams never."""
    optional = [n for n in known if n not in required]
    if not optional:
        return F.lit(None).cast(REASONS)
    none = F.lit(True)
    for n in optional:
        none = none & F.col(f"streams.{n}").isNull()
    for n in required:
        none = none & F.col(f"streams.{n}").isNotNull()
    return F.when(none, F.array(reason("ALL_OPTIONAL_STREAMS_MISSING")).cast(REASONS))


def content_key(time: str = "epoch_us") -> Column:
    """What makes rows copies: time and payloads, not the alignment."""
    return F.sha2(F.to_json(F.struct(time, "streams"), {"ignoreNullFields": "false"}), 256)


def dedup_exact(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """L4: adds duplicate_of_row_index, the first row of equal content in the session, or null for that one.

    The first rows come from a mergeable aggregate, so a content that fills the table is no hot task.
    """
    marked = rows.withColumn("_key", content_key() if key is None else key)
    # a null key is no copy; only contents that occur again are joined
    first = marked.where("_key is not null").groupBy("session_id", "_key").agg(F.min("row_index").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    out = marked.join(first, ["session_id", "_key"], "left")
    return out.withColumn("duplicate_of_row_index", F.when(F.col("row_index") > F.col("_first"), F.col("_first"))).drop("_key", "_first")


def redact(rows: DataFrame, paths: list[str]) -> DataFrame:
    """The payload fields at `stream.field` become null; adds redacted (the paths whose parent exists) and their number, n_redacted."""
    hit, streams = [], F.col("streams")
    shape = rows.schema["streams"].dataType
    for path in paths:
        parts = path.split(".")
        if not path or "" in parts:
            raise ValueError(f"bad path: {path!r}")
        if parts[0] not in shape.names:
            continue
        if len(parts) == 1:
            streams = streams.withField(path, F.lit(None).cast(shape[path].dataType))
            hit.append(F.lit(path))
        elif len(parts) == 2 and parts[1] in shape[parts[0]].dataType.names:
            streams = streams.withField(path, F.lit(None).cast(shape[parts[0]].dataType[parts[1]].dataType))
            hit.append(F.when(F.col(f"streams.{parts[0]}").isNotNull(), path))
    named = F.filter(F.array(*hit).cast("array<string>"), lambda x: x.isNotNull())
    return rows.withColumns({"streams": streams, "redacted": named, "n_redacted": F.size(named)})


def judged(rows: DataFrame, required: list[str] = (), least: int = 0, drop_without_optional: bool = False, dedup: bool = True, redact_paths: list[str] = ()) -> DataFrame:
    """The rows with reasons (null for rows kept), duplicate_of_row_index and, in the rows kept, redactions.

    Rules in the order L1, L2, L3, L4, L5; the first that drops a row ends it.  Written once, it serves
    both sides and the report.
    """
    known = rows.schema["streams"].dataType.names
    none = F.lit(None).cast(REASONS)
    first = F.when(F.size(required_streams(list(required))) > 0, required_streams(list(required)))
    rules = F.coalesce(first, min_present_streams(known, least), all_optional_missing(known, list(required)) if drop_without_optional else none)
    out = rows.withColumn("reasons", rules)
    if dedup:
        # rows that an earlier rule drops aren't copies of anything, nor are rows copies of them
        key = F.when(F.col("reasons").isNull(), content_key())
        out = dedup_exact(out, key)
        out = out.withColumn("reasons", F.when(F.col("duplicate_of_row_index").isNotNull(), F.array(reason("DUPLICATE_ROW")).cast(REASONS)).otherwise(F.col("reasons")))
    else:
        out = out.withColumn("duplicate_of_row_index", F.lit(None).cast("long"))
    clean_rows = redact(out.withColumn("_streams", F.col("streams")), list(redact_paths))
    kept = F.col("reasons").isNull()
    return clean_rows.withColumns({"streams": F.when(kept, F.col("streams")).otherwise(F.col("_streams")), "redacted": F.when(kept, F.col("redacted")), "n_redacted": F.when(kept, F.col("n_redacted"))}).drop("_streams")


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) of judged rows."""
    return marked.where("reasons is null").drop("reasons", "duplicate_of_row_index"), marked.where("reasons is not null").drop("redacted", "n_redacted")


def clean(rows: DataFrame, **rules) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped); rules as in `judged`."""
    return split(judged(rows, **rules))


def cleaning_report(kept: DataFrame, dropped: DataFrame, minimum_retained_rows: int = 1, most: int = MOST) -> DataFrame:
    """Counts per session; rejected without input or with too few rows left; details_truncated where examples are cut at `most`."""
    both = kept.groupBy("session_id").agg(F.count("*").alias("retained_rows"), F.sum((F.col("n_redacted") > 0).cast("long")).alias("redacted_rows"))
    gone = dropped.groupBy("session_id").agg(F.count("*").alias("dropped_rows"))
    out = both.join(gone, "session_id", "full").na.fill(0)
    out = out.withColumn("input_rows", F.col("retained_rows") + F.col("dropped_rows"))
    out = out.withColumn("retention_ratio", F.col("retained_rows") / F.col("input_rows"))
    out = out.withColumn("details_truncated", (F.col("dropped_rows") > most) | (F.col("redacted_rows") > most))
    return out.withColumn("status", F.when((F.col("input_rows") == 0) | (F.col("retained_rows") < minimum_retained_rows), "rejected").otherwise("completed"))


def reason_counts(dropped: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Every reason of every dropped row by its code, and FIELD_REDACTED for each field of the rows kept."""
    codes = dropped.select(F.explode("reasons.code").alias("reason"))
    if kept is not None:
        codes = codes.unionByName(kept.select(F.explode("redacted").alias("field")).select(F.lit("FIELD_REDACTED").alias("reason")))
    return codes.groupBy("reason").agg(F.count("*").alias("n"))


def examples(rows: DataFrame, most: int = MOST) -> DataFrame:
    """The first rows of each session, of the dropped ones or (with where("n_redacted > 0")) of the redacted."""
    order = Window.partitionBy("session_id").orderBy("row_index")
    return rows.withColumn("position", F.row_number().over(order)).where(F.col("position") <= most)


def redaction_examples(kept: DataFrame, most: int = MOST) -> DataFrame:
    """session_id, row_index, epoch_us and the redactions of the first redacted rows of each session."""
    first = examples(kept.where("n_redacted > 0"), most)
    return first.select("session_id", "row_index", "epoch_us", F.transform("redacted", lambda f: F.struct(F.lit("FIELD_REDACTED").alias("code"), f.alias("field"))).alias("redactions"))
