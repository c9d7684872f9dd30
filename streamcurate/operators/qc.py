"""Dataset quality control (Q1 to Q18) over samples.

Numeric leaves are unpivoted once into (path, value); one mergeable aggregate over that feeds every
check.  Issue rows: code, severity, path, observed, threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.storage import materialize
from ..functions.text import is_finite

PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
#: Issues kept in detail; counts are of all.
MOST = 1000


def leaves(shape: T.DataType, path: str) -> list[str]:
    if isinstance(shape, T.StructType):
        return [x for f in shape.fields for x in leaves(f.dataType, f"{path}.{f.name}")]
    return [path] if isinstance(shape, T.NumericType) else []


def scalar_features(samples: DataFrame, root: str = "features") -> DataFrame:
    """Q1: path and value of every numeric leaf; a missing block's leaves have present_block false."""
    paths = leaves(samples.schema[root].dataType, root)
    cells = [F.struct(F.lit(p).alias("path"), F.col(p).cast("double").alias("value"), F.col(p.rsplit(".", 1)[0]).isNotNull().alias("there")) for p in paths]
    return samples.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def long_form(table: DataFrame, columns: list[str]) -> DataFrame:
    """Q1 for flat tables."""
    return table.select(F.explode(F.array(*(F.struct(F.lit(c).alias("path"), F.col(c).cast("double").alias("value"), F.lit(True).alias("there")) for c in columns))).alias("x")).select("x.*")


def feature_profile(long: DataFrame, percentiles: bool = False) -> DataFrame:
    """Q2, Q3: counts and moments of each path over finite values; with `percentiles` also approximate ones."""
    good = F.when(is_finite(F.col("value")), F.col("value"))
    columns = [
        F.count("*").alias("total"),
        F.count(good).alias("present"),
        F.sum((F.col("there") & F.col("value").isNull()).cast("long")).alias("nulls"),
        F.sum(F.coalesce(~is_finite(F.col("value")), F.lit(False)).cast("long")).alias("non_finite"),
        F.sum((~F.col("there")).cast("long")).alias("missing"),
        F.avg(good).alias("mean"),
        F.var_pop(good).alias("variance"),
        F.stddev_pop(good).alias("std"),
        F.min(good).alias("min"),
        F.max(good).alias("max"),
    ]
    if percentiles:
        columns.append(F.percentile_approx(good, F.array(*map(F.lit, PERCENTILES)), 10_000).alias("percentiles"))
    return long.groupBy("path").agg(*columns)


#: Size of quantile sketches; their rank error is about 1.33 percent at 200 and falls in proportion.
SKETCH_K = 1600


def mergeable_profile(long: DataFrame) -> DataFrame:
    """What Q2 and Q3 are made of, so that profiles of parts can be merged: counts, mean, m2 (sum of squared deviations), extremes, a quantile sketch."""
    good = F.when(is_finite(F.col("value")), F.col("value"))
    part = feature_profile(long.withColumn("value", F.col("value"))).withColumn("m2", F.coalesce(F.col("variance") * F.col("present"), F.lit(0.0)))
    sketches = long.groupBy("path").agg(F.kll_sketch_agg_double(good, SKETCH_K).alias("sketch"))
    return part.drop("variance", "std").join(sketches, "path")


def merged_profiles(a: DataFrame, b: DataFrame) -> DataFrame:
    """One mergeable profile of two; each may lack paths of the other."""
    x, y = (df.select("path", F.struct(*[c for c in df.columns if c != "path"]).alias(name)) for df, name in ((a, "x"), (b, "y")))
    both = x.join(y, "path", "full")
    total = lambda c: F.coalesce(F.col(f"x.{c}"), F.lit(0)) + F.coalesce(F.col(f"y.{c}"), F.lit(0))
    n, m = F.coalesce("x.present", F.lit(0)), F.coalesce("y.present", F.lit(0))
    step = F.coalesce("y.mean", F.lit(0.0)) - F.coalesce("x.mean", F.lit(0.0))
    mean = F.when(n == 0, F.col("y.mean")).when(m == 0, F.col("x.mean")).otherwise(F.col("x.mean") + step * m / (n + m))
    m2 = total("m2") + F.when((n > 0) & (m > 0), step * step * n * m / (n + m)).otherwise(0.0)
    sketch = F.coalesce(F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.kll_sketch_merge_double("x.sketch", "y.sketch")), F.col("x.sketch"), F.col("y.sketch"))
    counts = [total(c).alias(c) for c in ("total", "present", "nulls", "non_finite", "missing")]
    return both.select("path", *counts, mean.alias("mean"), F.least("x.min", "y.min").alias("min"), F.greatest("x.max", "y.max").alias("max"), m2.alias("m2"), sketch.alias("sketch"))


def profile_of(state: DataFrame, at: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """Q2, Q3 and approximate percentiles from a mergeable profile."""
    variance = F.when(F.col("present") > 0, F.col("m2") / F.col("present"))
    picks = F.when(F.col("present") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, at))))
    return state.withColumns({"variance": variance, "std": F.sqrt(variance), "percentiles": picks}).drop("m2", "sketch")


def feature_percentiles(long: DataFrame, at: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """Q4: path and percentiles (array, interpolated), exact over all finite values.

    Equal values are counted first; the distinct ones are range-partitioned, and ranks come from the
    counts of the ranges before, so no task holds all values of a path.
    """
    counts = long.where(is_finite(F.col("value"))).groupBy("path", "value").agg(F.count("*").alias("n"))
    dealt = materialize(counts.repartitionByRange("path", "value").withColumn("part", F.spark_partition_id()), "values")
    before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("path", "part").agg(F.sum("n").alias("held")).select("path", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"), F.sum("held").over(Window.partitionBy("path")).alias("total"))
    upto = Window.partitionBy("path", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = dealt.withColumn("last", F.sum("n").over(upto)).join(bases, ["path", "part"]).withColumn("last", F.col("base") + F.col("last") - 1).withColumn("first", F.col("last") - F.col("n") + 1)
    place = lambda p: F.lit(float(p)) * (F.col("total") - 1)
    picks = []
    for i, p in enumerate(at):
        low, high = F.floor(place(p)), F.ceil(place(p))
        for side, rank in ((0, low), (1, high)):
            picks.append(F.when((F.col("first") <= rank) & (rank <= F.col("last")), F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), "value", (place(p) - low).alias("share"))))
    found = ranked.select("path", F.explode(F.filter(F.array(*picks), lambda x: x.isNotNull())).alias("x")).groupBy("path", "x.i").agg(F.max(F.when(F.col("x.side") == 0, F.col("x.value"))).alias("a"), F.max(F.when(F.col("x.side") == 1, F.col("x.value"))).alias("b"), F.max("x.share").alias("share"))
    value = F.struct("i", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("v"))
    return found.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(value)), lambda x: x["v"]).alias("percentiles"))


def modality_summary(samples: DataFrame, median: bool = True) -> DataFrame:
    """Q5: per stream the samples present and the coverage over windows; the median, exact, comes from ranks as in Q4."""
    names = samples.schema["modality_coverage"].dataType.names
    masked = "modality_mask" in samples.columns
    long = samples.select(F.explode(F.array(*(F.struct(F.lit(n).alias("stream"), F.col(f"modality_coverage.{n}").alias("c"), (F.col(f"modality_mask.{n}") if masked else F.col(f"modality_coverage.{n}") > 0).alias("p")) for n in names))).alias("x")).select("x.*")
    long = materialize(long, "coverage") if median else long
    out = long.groupBy("stream").agg(F.sum(F.col("p").cast("long")).alias("samples_present"), F.avg(F.col("p").cast("double")).alias("present_ratio"), F.avg("c").alias("mean_coverage"), F.min("c").alias("min_coverage"), F.max("c").alias("max_coverage"))
    if not median:
        return out
    middle = feature_percentiles(long.select(F.col("stream").alias("path"), F.col("c").cast("double").alias("value")), (0.5,)).select(F.col("path").alias("stream"), F.col("percentiles")[0].alias("median_coverage"))
    return out.join(middle, "stream", "left").select("stream", "samples_present", "present_ratio", "mean_coverage", "median_coverage", "min_coverage", "max_coverage")


def temporal_extent(samples: DataFrame) -> DataFrame:
    """Q6."""
    return samples.agg(F.min("start_us").alias("earliest_us"), F.max("end_us").alias("latest_us"), ((F.max("end_us") - F.min("start_us")) / 1e6).alias("duration_s"))


def window_size_summary(samples: DataFrame) -> DataFrame:
    """Q7."""
    return samples.agg(F.min("row_count").alias("min_rows"), F.max("row_count").alias("max_rows"), F.avg("row_count").alias("mean_rows"), F.stddev_pop("row_count").alias("std_rows"))


def issues(df: DataFrame, code: str, severity: Column | str, path: Column | str, observed: Column, threshold: Column | float | None) -> DataFrame:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.select(F.lit(code).alias("code"), lit(severity).alias("severity"), (F.col(path) if isinstance(path, str) else path).cast("string").alias("path"), observed.cast("double").alias("observed"), lit(threshold).cast("double").alias("threshold"))


def check_dataset_size(samples: DataFrame, minimum: int) -> DataFrame:
    """Q8."""
    n = samples.agg(F.count("*").alias("n"))
    code = F.when(F.col("n") == 0, "EMPTY_DATASET").when(F.col("n") < minimum, "DATASET_TOO_SMALL")
    found = issues(n.withColumn("code", code).where("code is not null"), "", "error", F.lit("dataset"), F.col("n"), float(minimum))
    return found.withColumn("code", F.when(F.col("observed") == 0, "EMPTY_DATASET").otherwise("DATASET_TOO_SMALL"))


def check_modality_coverage(summary: DataFrame, minimums: dict[str, float], severity: str = "error") -> DataFrame:
    """Q9: a stream that isn't there counts as 0."""
    if not minimums:
        return issues(summary.where("false"), "LOW_MODALITY_COVERAGE", severity, "stream", F.col("present_ratio"), 0.0)
    need = summary.sparkSession.createDataFrame(list(minimums.items()), "stream string, minimum double")
    low = need.join(summary, "stream", "left").withColumn("ratio", F.coalesce("present_ratio", F.lit(0.0))).where("ratio < minimum")
    return issues(low, "LOW_MODALITY_COVERAGE", severity, "stream", F.col("ratio"), F.col("minimum"))


def check_completeness(profile: DataFrame, maximum: float, overrides: dict[str, tuple[float, str]] | None = None, severity: str = "warning") -> DataFrame:
    """Q10: 1 - present / total over the allowed ratio, with overrides by path."""
    limit, level = F.lit(maximum), F.lit(severity)
    for path, (ratio, sev) in (overrides or {}).items():
        limit, level = F.when(F.col("path") == path, ratio).otherwise(limit), F.when(F.col("path") == path, sev).otherwise(level)
    bad = profile.withColumns({"missing_ratio": 1 - F.col("present") / F.col("total"), "limit": limit, "level": level}).where("missing_ratio > limit")
    return issues(bad, "LOW_FEATURE_COMPLETENESS", F.col("level"), "path", F.col("missing_ratio"), F.col("limit"))


def check_variance(profile: DataFrame, minimum: float = 1e-12, severity: str = "warning") -> DataFrame:
    """Q11."""
    return issues(profile.where((F.col("present") >= 2) & (F.col("variance") < minimum)), "LOW_FEATURE_VARIANCE", severity, "path", F.col("variance"), minimum)


def check_range(profile: DataFrame, ranges: dict[str, tuple[float | None, float | None]], severity: str = "error") -> DataFrame:
    """Q12: the lower side is reported first, only one side per path."""
    low = high = F.lit(None).cast("double")
    for path, (a, b) in ranges.items():
        low, high = F.when(F.col("path") == path, F.lit(a).cast("double")).otherwise(low), F.when(F.col("path") == path, F.lit(b).cast("double")).otherwise(high)
    df = profile.where("present > 0").withColumns({"low": low, "high": high})
    under, over = F.coalesce(F.col("min") < F.col("low"), F.lit(False)), F.coalesce(F.col("max") > F.col("high"), F.lit(False))
    return issues(df.where(under | over), "FEATURE_RANGE_VIOLATION", severity, "path", F.when(under, F.col("min")).otherwise(F.col("max")), F.when(under, F.col("low")).otherwise(F.col("high")))


def check_non_finite(profile: DataFrame) -> DataFrame:
    """Q13."""
    return issues(profile.where("non_finite > 0"), "NON_FINITE_FEATURE_VALUE", "error", "path", F.col("non_finite"), 0.0)


def duplicate_sample_ids(samples: DataFrame, order: str = "k") -> DataFrame:
    """Q14: every repeat with the first row's order value."""
    first = samples.groupBy("sample_id").agg(F.min(order).alias("first_index"), F.count("*").alias("n")).where("n > 1")
    return samples.join(first, "sample_id").where(F.col(order) > F.col("first_index")).select("sample_id", F.col(order).alias("index"), "first_index")


def sample_time_order(samples: DataFrame) -> DataFrame:
    """Q15: samples that start before the one before them."""
    w = Window.partitionBy("session_id").orderBy("k")
    return samples.withColumn("previous_us", F.lag("start_us").over(w)).where("start_us < previous_us").select("session_id", "k", "start_us", "previous_us")


def group_imbalance(rows: DataFrame, group: str, maximum: float) -> DataFrame:
    """Q16: groups with more than their share, if there are at least two groups."""
    counts = rows.groupBy(group).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.count("*").alias("groups"))
    out = counts.crossJoin(F.broadcast(total)).where("groups >= 2").withColumn("fraction", F.col("n") / F.col("total"))
    return out.where(F.col("fraction") > maximum).select(group, "n", "fraction")


def drift(current: DataFrame, baseline: DataFrame, maximum: float = 3.0) -> DataFrame:
    """Q17: distance of means in the baseline's standard deviations, for every path of the current profile."""
    cur = current.select("path", F.col("mean").alias("current_mean"), F.col("present").alias("cp"))
    base = baseline.select("path", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std"), F.col("present").alias("bp"))
    df = cur.join(base, "path", "left").withColumn("baseline_std", F.when(F.col("bp") > 0, F.coalesce("baseline_std", F.lit(0.0))))
    lacks = F.when(F.coalesce("cp", F.lit(0)) == 0, "missing_in_current").when(F.coalesce("bp", F.lit(0)) == 0, "missing_in_baseline")
    flat = F.col("baseline_std") == 0
    same = F.col("current_mean") == F.col("baseline_mean")
    score = F.when(lacks.isNotNull(), None).when(flat & same, 0.0).when(flat, None).otherwise((F.col("current_mean") - F.col("baseline_mean")) / F.col("baseline_std"))
    reason = F.coalesce(lacks, F.when(flat & ~same, F.lit("baseline_std_zero_mean_shifted")))
    df = df.withColumns({"compared": lacks.isNull(), "score": score, "reason": reason})
    return df.select("path", "compared", "score", "reason", F.coalesce((F.abs("score") > maximum) | (F.col("reason") == "baseline_std_zero_mean_shifted"), F.lit(False)).alias("drifted"))


def baseline_incompatible(spark, current: tuple[str, str], baseline: tuple[str, str]) -> DataFrame:
    """Q17: a warning where the baseline was made with another profile (name, version)."""
    one = spark.range(1).where(F.lit(tuple(current) != tuple(baseline)))
    return issues(one, "BASELINE_INCOMPATIBLE", "warning", F.lit("@".join(baseline)), F.lit(None), None)


def qc_report(
    samples: DataFrame,
    minimum_samples: int = 1,
    coverage: dict | None = None,
    missing: float = 1.0,
    ranges: dict | None = None,
    maximum_group: float = 1.0,
    baseline: DataFrame | None = None,
    profile_name: tuple[str, str] = ("default", "1.0.0"),
    baseline_name: tuple[str, str] = ("default", "1.0.0"),
    most: int = MOST,
) -> tuple[DataFrame, DataFrame]:
    """Q18: (issues, one-row report with counts, status and whether details beyond `most` are left out by `bounded`)."""
    profile = materialize(feature_profile(scalar_features(samples)), "profile")
    repeated, late, uneven = duplicate_sample_ids(samples), sample_time_order(samples), group_imbalance(samples, "session_id", maximum_group)
    parts = [
        check_dataset_size(samples, minimum_samples),
        check_modality_coverage(modality_summary(samples, median=False), coverage or {}),
        check_completeness(profile, missing),
        check_variance(profile),
        check_range(profile, ranges or {}),
        check_non_finite(profile),
        issues(repeated, "DUPLICATE_SAMPLE_ID", "error", "sample_id", F.col("index"), F.col("first_index")),
        issues(late, "NON_MONOTONIC_SAMPLE_TIME", "warning", "session_id", F.col("start_us"), F.col("previous_us")),
        issues(uneven, "GROUP_IMBALANCE", "warning", "session_id", F.col("fraction"), maximum_group),
    ]
    if baseline is not None:
        parts.append(baseline_incompatible(samples.sparkSession, profile_name, baseline_name))
        parts.append(issues(drift(profile, baseline).where("drifted"), "FEATURE_DISTRIBUTION_DRIFT", "warning", "path", F.col("score"), None))
    found = reduce(lambda a, b: a.unionByName(b), [p.withColumn("check", F.lit(i)) for i, p in enumerate(parts)])
    count = lambda s: F.coalesce(F.sum((F.col("severity") == s).cast("long")), F.lit(0))
    report = found.agg(F.count("*").alias("issue_count"), count("error").alias("error_count"), count("warning").alias("warning_count")).withColumn("issues_truncated", F.col("issue_count") > most)
    return found, report.withColumn("status", F.when(F.col("error_count") > 0, "failed").when(F.col("warning_count") > 0, "passed_with_warnings").otherwise("passed"))


def bounded(found: DataFrame, most: int = MOST) -> DataFrame:
    """Q18: the first `most` issues, in the order of the checks."""
    return found.orderBy("check", "path", "observed").limit(most)
