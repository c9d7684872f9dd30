"""Leakage-safe splitting and packaging of samples."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import BLOCK, block_of, name_of, positions
from ..functions.storage import materialize
from ..sources.files import write_splits_jsonl, write_splits_parquet

SPLITS = ("train", "validation", "test")
ACCEPTED = ("passed", "passed_with_warnings")


def check_sample_identity(samples: DataFrame) -> DataFrame:
    """Missing or repeated sample ids; empty when all is well."""
    return samples.groupBy("sample_id").agg(F.count("*").alias("n")).where("sample_id is null or n > 1")


def group_name(*parts) -> Column:
    return F.concat(F.lit("grp_"), F.substring(F.sha2(F.concat_ws(":", *(F.col(p).cast("string") if isinstance(p, str) else p for p in parts)), 256), 1, 16))


def overlap_groups(samples: DataFrame, sha: str = "", block: int = BLOCK, content: str | None = None) -> DataFrame:
    """Adds group_id; chains of inclusive row ranges that touch rows of each other (gaps and islands).

    content: the column with the checksum of the artifact that a sample comes from; a group is then named by
    checksum, first and last row.  Without it `sha` stands for all samples, and the session is part of the name.

    Sessions are cut into blocks of first rows; ends and chains reach into later blocks by one summary
    row per block.  A sample without a range is an error when run.
    """
    there = F.col("source_row_start").isNotNull() & F.col("source_row_end").isNotNull()
    start = F.when(there, F.col("source_row_start")).otherwise(F.raise_error(F.concat(F.lit("MISSING_GROUP_METADATA: "), F.coalesce(F.col("sample_id").cast("string"), F.lit("-")))).cast("long"))
    rows = samples.withColumn("source_row_start", start).withColumns({"_name": name_of(["session_id"]), "_block": block_of("source_row_start", block)})
    keys = ["_name", "_block"]
    blocks = Window.partitionBy("_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    reach = rows.groupBy(*keys).agg(F.max("source_row_end").alias("_end")).select(*keys, F.max("_end").over(blocks).alias("_reach"))
    order = Window.partitionBy(*keys).orderBy("source_row_start", "source_row_end", "sample_id")
    past, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("_own", F.max("source_row_end").over(past)).join(reach, keys)
    fresh = F.coalesce(F.col("source_row_start") > F.greatest("_own", "_reach"), F.lit(True)).cast("long")
    marked = seen.withColumn("_new", fresh).withColumn("_chain", F.sum("_new").over(upto))
    bases = marked.groupBy(*keys).agg(F.sum("_new").alias("_n")).select(*keys, F.coalesce(F.sum("_n").over(blocks), F.lit(0)).alias("_base"))
    chained = marked.join(bases, keys).withColumn("_island", F.col("_base") + F.col("_chain"))
    ends = chained.groupBy("_name", "_island").agg(F.min("source_row_start").alias("_a"), F.max("source_row_end").alias("_b"))
    name = group_name(content, "_a", "_b") if content else group_name(F.lit(sha), "session_id", "_a", "_b")
    return chained.join(ends, ["_name", "_island"]).select(*samples.columns, name.alias("group_id"))


def session_groups(samples: DataFrame, content: str | None = None) -> DataFrame:
    """One group per session; with `content`, the column of the artifact's checksum, per artifact and session."""
    return samples.withColumn("group_id", group_name(content, F.lit("session"), "session_id") if content else group_name("session_id"))


def check_ratios(train: float, validation: float, test: float) -> None:
    if min(train, validation, test) < 0 or train <= 0 or abs(train + validation + test - 1) > 1e-6:
        raise ValueError("ratios have to be non-negative and sum to 1, train above 0")


def hash_split(group: Column, train: float, validation: float, test: float, seed: int = 42, profile: str = "default", version: str = "1.0.0") -> Column:
    """A group's split from its own name alone."""
    check_ratios(train, validation, test)
    text = F.concat_ws(":", group, F.lit(str(seed)), F.lit(profile), F.lit(version))
    share = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return F.when(share < train, "train").when(share < train + validation, "validation").otherwise("test")


def sequential_split(groups: DataFrame, train: float, validation: float, test: float) -> DataFrame:
    """P5: groups (group_id, position, n) in order fill one split after the other; empty ratios are skipped.

    A split takes the groups whose preceding count, from its own base on, is below its share.  The
    bases are scalars, found one per split; prefix sums run per range of positions.
    """
    check_ratios(train, validation, test)
    # prefix sums in two steps, so that no task holds all groups
    wide = groups.withColumn("_part", F.floor(F.col("position") / F.lit(100_000)))
    parts = wide.groupBy("_part").agg(F.sum("n").alias("_n"))
    base = parts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    prefix = wide.join(base, "_part").withColumn("prefix", F.col("_base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).drop("_part", "_base")
    total = groups.agg(F.sum("n")).first()[0] or 0
    ratios = [(name, r) for name, r in zip(SPLITS, (train, validation, test), strict=True) if r > 0]
    start, label = 0, F.lit(ratios[-1][0])
    bounds = []
    for name, ratio in ratios[:-1]:
        stop = prefix.where((F.col("prefix") >= start) & (F.col("prefix") - start >= ratio * total)).agg(F.min("prefix")).first()[0]
        bounds.append((name, stop))
        if stop is None:
            break
        start = stop
    for name, stop in reversed(bounds):
        label = F.lit(name) if stop is None else F.when(F.col("prefix") < stop, name).otherwise(label)
    return prefix.withColumn("split", label).drop("prefix")


def leakage_audit(index: DataFrame, source: DataFrame | None = None, overlaps: bool = True) -> DataFrame:
    """One row: duplicate ids, groups and (re-derived) overlap chains in several splits, samples, passed.

    With `source`, the samples that were to be packaged, their number has to be the same.
    """
    ids = check_sample_identity(index).agg(F.count("*").alias("duplicate_sample_ids"))
    several = lambda df, key, name: df.groupBy(*key).agg(F.countDistinct("split").alias("s")).where("s > 1").agg(F.count("*").alias(name))
    groups = several(index, ["group_id"], "groups_in_several_splits")
    chains = several(overlap_groups(index.drop("group_id")), ["group_id"], "chains_in_several_splits") if overlaps else index.sparkSession.range(1).select(F.lit(0).cast("long").alias("chains_in_several_splits"))
    total = index.agg(F.count("*").alias("samples"))
    wanted = (index if source is None else source).agg(F.count("*").alias("source_samples"))
    one = reduce(lambda a, b: a.crossJoin(b), [ids, groups, chains, total, wanted])
    return one.withColumn("passed", F.expr("duplicate_sample_ids = 0 AND groups_in_several_splits = 0 AND chains_in_several_splits = 0 AND samples = source_samples"))


def require_audit(audit: DataFrame) -> None:
    """Raises where packages may not be committed."""
    found = audit.first()
    if found.samples != found.source_samples:
        raise ValueError(f"SAMPLE_COUNT_MISMATCH: {found.samples} packaged of {found.source_samples}")
    if not found.passed:
        raise ValueError(f"LEAKAGE_INVARIANT_VIOLATION: {found.asDict()}")


def split_stats(index: DataFrame) -> DataFrame:
    """Samples, groups and share of each split, all three always."""
    names = index.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    counts = index.groupBy("split").agg(F.count("*").alias("samples"), F.countDistinct("group_id").alias("groups"))
    total = index.agg(F.count("*").alias("total"))
    out = names.join(counts, "split", "left").na.fill(0).crossJoin(F.broadcast(total))
    return out.withColumn("sample_ratio", F.when(F.col("total") > 0, F.col("samples") / F.col("total")).otherwise(0.0)).drop("total")


def package_status(stats: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """One row: status and the reasons of a rejection; without any sample that is the only one."""
    asked = [s for s, r in ratios.items() if r > 0]
    one = stats.agg(F.sum("samples").alias("n"), F.sum("groups").alias("g"), F.max(((F.col("samples") == 0) & F.col("split").isin(asked)).cast("int")).alias("empty"))
    few = F.filter(F.array(F.when(F.col("g") < len(asked), "INSUFFICIENT_GROUPS_FOR_SPLIT"), F.when(F.col("empty") == 1, "EMPTY_REQUESTED_SPLIT")), lambda x: x.isNotNull())
    reasons = F.when(F.col("n") == 0, F.array(F.lit("EMPTY_SOURCE_DATASET"))).otherwise(few)
    return one.select(F.when(F.size(reasons) > 0, "rejected").otherwise("completed").alias("status"), reasons.alias("reasons"))


def split_index(samples: DataFrame) -> DataFrame:
    """P9."""
    return samples.select("session_id", "sample_id", "group_id", "split", "source_row_start", "source_row_end")


def qc_gate(samples_meta: DataFrame, reports: DataFrame) -> DataFrame:
    """P10: datasets with an accepted report for the same transformation and checksum."""
    ok = reports.where(F.col("status").isin(*ACCEPTED)).select("transformation_id", "sha256").distinct()
    return samples_meta.join(ok, ["transformation_id", "sha256"], "left_semi")


def report_refusal(requests: DataFrame, reports: DataFrame) -> DataFrame:
    """Adds `refused`, why the QC report that a request names may not be used, or null.

    requests: qc_id, transformation_id, sha256 (of the artifact as it is now); reports: qc_id,
    transformation_id, sha256 (of the artifact then), status, and, if they are to be checked,
    report_json and report_sha256.  A report has to be of the same transformation and content, unchanged, and accepted.
    """
    checked = {"report_json", "report_sha256"} <= set(reports.columns)
    intact = F.sha2(F.col("report_json").cast("string"), 256).eqNullSafe(F.col("report_sha256")) if checked else F.lit(True)
    own = reports.select("qc_id", F.struct("transformation_id", "sha256", "status", intact.alias("intact")).alias("_r"))
    out = requests.join(own, "qc_id", "left")
    same = lambda c: F.col(f"_r.{c}").eqNullSafe(F.col(c))
    why = F.when(F.col("_r").isNull(), "QC_NOT_FOUND").when(~same("transformation_id"), "QC_TRANSFORMATION_MISMATCH").when(~same("sha256"), "ARTIFACT_CHECKSUM_MISMATCH").when(~F.col("_r.intact"), "QC_REPORT_CHECKSUM_MISMATCH").when(~F.coalesce(F.col("_r.status").isin(*ACCEPTED), F.lit(False)), "QC_NOT_ACCEPTED")
    return out.withColumn("refused", why).drop("_r").select(*requests.columns, "refused")


@dataclass
class Package:
    """Samples with group_id and split; one-row audit and status; statistics of the splits."""

    samples: DataFrame
    audit: DataFrame
    stats: DataFrame
    status: DataFrame


def package(samples: DataFrame, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), grouping: str = "overlap", strategy: str = "hash", seed: int = 42, reports: DataFrame | None = None, request: dict | None = None, content: str | None = None) -> Package:
    """Groups, splits, audit and status of the samples.

    With `reports` (see `report_refusal`), the request (qc_id, transformation_id, sha256) has to name an accepted
    one of this transformation and content, or packaging is refused.  content: as in `overlap_groups`.
    """
    check_ratios(*ratios)
    if grouping not in ("overlap", "session") or strategy not in ("hash", "sequential"):
        raise ValueError("unknown grouping or strategy")
    if reports is not None:
        if not {"qc_id", "transformation_id", "sha256", "status"} <= set(reports.columns):
            raise ValueError("QC_NOT_ACCEPTED: reports have to name qc_id, transformation_id and sha256")
        asked = [(request or {}).get(c) for c in ("qc_id", "transformation_id", "sha256")]
        one = samples.sparkSession.createDataFrame([tuple(None if x is None else str(x) for x in asked)], "qc_id string, transformation_id string, sha256 string")
        same = reports.withColumns({c: F.col(c).cast("string") for c in one.columns}).where(F.col("qc_id") == F.lit(one.first().qc_id))
        for found in report_refusal(one, same).take(2):
            if found.refused:
                raise ValueError(found.refused)
    grouped = overlap_groups(samples, content=content) if grouping == "overlap" else session_groups(samples, content)
    if strategy == "hash":
        out = grouped.withColumn("split", hash_split(F.col("group_id"), *ratios, seed=seed))
    else:
        firsts = grouped.groupBy("group_id").agg(F.min(F.struct("session_id", "source_row_start", "sample_id")).alias("f"), F.count("*").alias("n"))
        ordered = positions(firsts.select("group_id", "n", "f.*"), "session_id", "source_row_start", "sample_id", "group_id").select("group_id", "position", "n")
        out = grouped.join(sequential_split(ordered, *ratios).select("group_id", "split"), "group_id")
    out = materialize(out, "packaged")
    stats = split_stats(out)
    return Package(out, leakage_audit(split_index(out), samples, grouping == "overlap"), stats, package_status(stats, dict(zip(SPLITS, ratios, strict=True))))


def commit(made: Package, path: str, parquet: bool = False) -> None:
    """Audited first (P6), then written: JSON lines by split (I8), Parquet if asked for (I9), split index (P9), and the status last.

    A package without its status isn't one: a run that broke off leaves files which `committed` refuses.
    """
    require_audit(made.audit)
    write_splits_jsonl(made.samples, f"{path}/jsonl")
    if parquet:
        write_splits_parquet(made.samples, f"{path}/parquet")
    split_index(made.samples).write.parquet(f"{path}/index")
    stats = made.stats.agg(F.array_sort(F.collect_list(F.struct("split", "samples", "groups", "sample_ratio"))).alias("splits"))
    made.status.crossJoin(stats).crossJoin(made.audit.select(F.struct("*").alias("audit"))).coalesce(1).write.option("ignoreNullFields", False).json(f"{path}/status")


STATUS = "status string, reasons array<string>, splits array<struct<split:string,samples:long,groups:long,sample_ratio:double>>, audit struct<duplicate_sample_ids:long,groups_in_several_splits:long,chains_in_several_splits:long,samples:long,source_samples:long,passed:boolean>"


def committed(spark: SparkSession, path: str, accept: tuple[str, ...] = ("completed",)) -> tuple[DataFrame, DataFrame]:
    """The status row and the split index of a package; refused without a status, or with another than accepted."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/status/_SUCCESS")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise ValueError("PACKAGE_NOT_COMMITTED")
    status = spark.read.schema(STATUS).json(f"{path}/status")
    if (found := status.first()).status not in accept:
        raise ValueError(f"PACKAGE_{found.status.upper()}: {', '.join(found.reasons)}")
    return status, spark.read.parquet(f"{path}/index")
