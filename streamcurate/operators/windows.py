"""Count and time windows over synchronized rows (W1 to W3), and window features.

Windows are planned by arithmetic on a row's number or time, so one explode and one grouped
aggregate with map-side combining build them; no cursor walks a session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import numbered
from ..functions.text import is_finite
from .sync import assert_monotonic

STATISTICS = ("mean", "std", "min", "max", "median", "first", "last", "delta")
MAX_SIZE, MAX_DURATION_MS = 100_000, 3_600_000
EARTH_M = 6_371_000.0


def count_windows(rows: DataFrame, size: int, stride: int, drop_incomplete: bool = True, order: str = "row_index") -> DataFrame:
    """Rows with k, once for each window they are in; at most one partial window ends a session."""
    if not (0 < size <= MAX_SIZE and stride > 0):
        raise ValueError("size has to be in 1..100000 and stride positive")
    df = numbered(rows, ["session_id"], order)
    full = F.when(F.col("n") >= size, F.floor((F.col("n") - size) / F.lit(stride)) + 1).otherwise(0).cast("long")
    low = F.greatest(F.lit(0), F.ceil((F.col("i") - size + 1) / F.lit(stride))).cast("long")
    high = F.floor(F.col("i") / F.lit(stride)).cast("long")
    df = df.withColumns({"_full": full, "_lo": low, "_hi": high}).where("_lo <= _hi")
    out = df.withColumn("k", F.explode(F.sequence("_lo", "_hi")))
    keep = F.col("k") < F.col("_full") if drop_incomplete else F.col("k") <= F.col("_full")
    return out.where(keep).drop("_full", "_lo", "_hi", "n")


def time_windows(rows: DataFrame, duration_ms: float, stride_ms: float, drop_incomplete: bool = True) -> DataFrame:
    """Rows with k; half-open windows from the session's first row on; dropped ones are those no later row closes."""
    duration, stride = int(duration_ms * 1000), int(stride_ms * 1000)
    if not (0 < duration <= MAX_DURATION_MS * 1000 and stride > 0):
        raise ValueError("duration has to be in (0, 1 h] and stride positive")
    return _time_windows(rows, duration, stride, drop_incomplete)


def _time_windows(rows: DataFrame, duration: int, stride: int, drop_incomplete: bool) -> DataFrame:
    ends = rows.groupBy("session_id").agg(F.min("epoch_us").alias("_first"), F.max("epoch_us").alias("_last"))
    df = rows.join(ends, "session_id").withColumn("_rel", F.col("epoch_us") - F.col("_first"))
    low = F.greatest(F.lit(0), F.floor((F.col("_rel") - duration) / F.lit(stride)) + 1).cast("long")
    high = F.floor(F.col("_rel") / F.lit(stride)).cast("long")
    df = df.withColumns({"_lo": low, "_hi": high}).where("_lo <= _hi").withColumn("k", F.explode(F.sequence("_lo", "_hi")))
    if drop_incomplete:
        df = df.where(F.col("_last") - F.col("_first") >= F.col("k") * stride + duration)
    return df.drop("_first", "_last", "_rel", "_lo", "_hi")


def assert_row_order(rows: DataFrame) -> DataFrame:
    """The rows; running it fails where time goes back."""
    return assert_monotonic(rows.withColumn("record_number", F.col("row_index"))).drop("record_number")


def magnitude(axes: list[Column]) -> Column:
    """Euclidean norm, null unless all axes are there."""
    return F.sqrt(sum((a * a for a in axes[1:]), axes[0] * axes[0]))


def statistic(value: Column, name: str, order: str = "row_index") -> Column:
    """over the values that aren't null; std is the population's, median the mean of the middle two."""
    at = F.when(value.isNotNull(), F.col(order))
    first, last = F.min_by(value, at), F.max_by(value, at)
    return {
        "mean": lambda: F.avg(value),
        "std": lambda: F.stddev_pop(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "median": lambda: F.percentile(value, F.lit(0.5)),
        "first": lambda: first,
        "last": lambda: last,
        "delta": lambda: last - first,
    }[name]()


def raw_sequence(value: Column, order: str = "row_index") -> Column:
    """the values that aren't null, in row order."""
    kept = F.collect_list(F.when(value.isNotNull(), F.struct(F.col(order).alias("o"), value.alias("v"))))
    return F.transform(F.array_sort(kept), lambda x: x["v"])


def displacement_m(lat: Column, lon: Column, order: str = "row_index") -> Column:
    """haversine from the first to the last latitude and longitude, each at least twice there."""
    a, b = (F.radians(statistic(lat, x, order)) for x in ("first", "last"))
    c, d = (F.radians(statistic(lon, x, order)) for x in ("first", "last"))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((d - c) / 2), 2)
    return F.when((F.count(lat) >= 2) & (F.count(lon) >= 2), F.asin(F.sqrt(F.least(F.lit(1.0), h))) * (2 * EARTH_M))


def sample_id(cleaned_sha: str, config_hash: str, k: Column, start: Column, end: Column) -> Column:
    """F9."""
    text = F.concat_ws(":", F.lit(cleaned_sha), F.lit(config_hash), k.cast("string"), start.cast("string"), end.cast("string"))
    return F.concat(F.lit("sample_"), F.substring(F.sha2(text, 256), 1, 32))


def require_finite(value: Column, path: str) -> Column:
    """running it fails on NaN or infinity."""
    return F.when(value.isNotNull() & ~is_finite(value), F.raise_error(F.lit(f"{path} isn't finite")).cast("double")).otherwise(value)


def transform(windowed: DataFrame, features: dict[str, dict], cleaned_sha: str = "", config_hash: str = "", mask: bool = True, relative_time: bool = False, finite: str = "fail") -> DataFrame:
    """samples of windowed rows (with k).  Sample ids are of session and window number, so they differ between sessions.

    features: stream to {"fields": [...], "statistics": [...], "raw": bool, "magnitudes": {name:
    axes}, "displacement": bool}.  Magnitudes join raw and statistics like fields.
    """
    known = windowed.schema["streams"].dataType.names
    blocks = []
    for stream, config in features.items():
        if stream not in known:
            raise ValueError(f"unknown stream {stream!r}")
        unknown = set(config.get("statistics", ())) - set(STATISTICS)
        if unknown:
            raise ValueError(f"unknown statistics {sorted(unknown)}")
        values = {f: F.col(f"streams.{stream}.{f}") for f in config.get("fields", ())}
        values |= {n: magnitude([F.col(f"streams.{stream}.{a}") for a in axes]) for n, axes in config.get("magnitudes", {}).items()}
        if finite == "fail":
            values = {n: require_finite(v, f"{stream}.{n}") for n, v in values.items()}
        parts = []
        if config.get("raw"):
            parts.append(F.struct(*(raw_sequence(v).alias(n) for n, v in values.items())).alias("raw"))
        if config.get("statistics"):
            parts.append(F.struct(*(statistic(v, s).alias(f"{n}_{s}") for n, v in values.items() for s in config["statistics"])).alias("statistics"))
        if config.get("displacement"):
            parts.append(F.struct(displacement_m(F.col(f"streams.{stream}.latitude"), F.col(f"streams.{stream}.longitude")).alias("displacement_m")).alias("derived"))
        if parts:
            blocks.append(F.struct(*parts).alias(stream))
    there = {n: F.col(f"streams.{n}").isNotNull() for n in known}
    columns = [
        F.min("epoch_us").alias("start_us"),
        F.max("epoch_us").alias("end_us"),
        F.count("*").alias("row_count"),
        F.min("row_index").alias("source_row_start"),
        F.max("row_index").alias("source_row_end"),
        F.struct(*(F.avg(c.cast("double")).alias(n) for n, c in there.items())).alias("modality_coverage"),
    ]
    if blocks:
        columns.append(F.struct(*blocks).alias("features"))
    if mask:
        columns.append(F.struct(*(F.max(c).alias(n) for n, c in there.items())).alias("modality_mask"))
    if relative_time:
        columns.append(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "epoch_us"))), lambda x: x["epoch_us"]).alias("_times"))
    out = windowed.groupBy("session_id", "k").agg(*columns)
    if relative_time:
        out = out.withColumn("relative_time_ms", F.transform("_times", lambda t: (t - F.col("_times")[0]) / 1000.0)).drop("_times")
    return out.withColumn("sample_id", sample_id(cleaned_sha, config_hash, F.concat_ws("/", F.col("session_id").cast("string"), F.col("k").cast("string")), F.col("start_us"), F.col("end_us")))


def transform_report(samples: DataFrame) -> DataFrame:
    """per stream the windows present, their share, and the features of a window."""
    names = samples.schema["modality_coverage"].dataType.names
    shape = samples.schema["features"].dataType if "features" in samples.columns else None
    count = {n: sum(len(b.dataType.names) for b in shape[n].dataType.fields) if shape and n in shape.names else 0 for n in names}
    long = samples.select("row_count", F.explode(F.array(*(F.struct(F.lit(n).alias("stream"), F.lit(count[n]).alias("features"), F.col(f"modality_coverage.{n}").alias("c")) for n in names))).alias("x"))
    return long.groupBy("x.stream", "x.features").agg(F.count("*").alias("samples"), F.avg("row_count").alias("avg_rows"), F.sum((F.col("x.c") > 0).cast("long")).alias("windows_present"), F.avg((F.col("x.c") > 0).cast("double")).alias("present_ratio"))
