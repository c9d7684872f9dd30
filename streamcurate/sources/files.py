"""Files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.storage import materialize
from ..specs import SensorSpec
from .csv_splits import named, split_csv
from .json_splits import split_json

#: What may be ingested, and the largest file.
EXTENSIONS = (".csv", ".json", ".jsonl", ".zip")
MAX_BYTES = 512 * 1024 * 1024
#: Up to so many blocks of files are broadcast; more are joined by shuffle.
BROADCAST_BLOCKS = 100_000


def with_record_number(df: DataFrame, file: str = "_file", block: str = "_block") -> DataFrame:
    """I4: the 1-based order of records in each file.

    A block's rows are read by one task in their order, with consecutive ids; the rows of the blocks
    before it come from one count per block.  So a file is read in splits and never sorted.
    """
    blocks = df.groupBy(file, block).agg(F.min("_order").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select(file, block, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    bases = materialize(bases, "blocks")
    bases = F.broadcast(bases) if bases.count() <= BROADCAST_BLOCKS else bases
    return df.join(bases, [file, block]).withColumn("record_number", F.col("_order") - F.col("_first") + F.col("_base") + 1).drop("_first", "_base")


def located(df: DataFrame) -> DataFrame:
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_order": F.monotonically_increasing_id()})


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """file, record_number (the physical line), value."""
    rows = with_record_number(located(spark.read.text(paths)))
    return rows.select(F.col("_file").alias("file"), "record_number", "value")


def read_csv(spark: SparkSession, paths, columns: list[str]) -> DataFrame:
    """File, record_number and all cells as text, by the names in each file's own header.

    Extra cells drop out, cells that a row or a header lacks are null; quoted newlines are part of a cell.
    """
    return named(split_csv(spark, paths), columns)


def read_jsonl(spark: SparkSession, paths) -> DataFrame:
    """File, record_number (line), value; blank lines are skipped but counted."""
    return read_lines(spark, paths).where(F.trim("value") != "")


def read_json(spark: SparkSession, paths) -> DataFrame:
    """File, record_number, value: the items of each file's array, or its one value; a file that isn't JSON is one invalid record."""
    return split_json(spark, paths)


#: Bytes of a file that are held at once while it is hashed.
HASH_CHUNK = 8 << 20
#: Schemes of addresses that workers open themselves, in pieces; files elsewhere are read whole by Spark (2 GB at most).
STREAMED = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def streamed_hashes(files: DataFrame, chunk: int = HASH_CHUNK) -> DataFrame:
    """path, length, modified and sha256 of files (path, length, modified), each read in pieces of `chunk` bytes."""

    def run(batches):
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                address = path.replace("s3a://", "s3://", 1)
                store, name = (fs.LocalFileSystem(), address.removeprefix("file://").removeprefix("file:")) if address.startswith("file:") else fs.FileSystem.from_uri(address)
                own = hashlib.sha256()
                with store.open_input_file(name) as source:
                    while piece := source.read(chunk):
                        own.update(piece)
                found.append(own.hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("path", "length", "modified")), pa.array(found, pa.string())], ["path", "length", "modified", "sha256"])

    # one file after the other in a task, and the largest ones spread
    dealt = files.select("path", "length", "modified").repartition("path")
    return dealt.mapInArrow(run, "path string, length long, modified timestamp, sha256 string")


def hashed_files(spark: SparkSession, paths, most: int | None = None) -> DataFrame:
    """path, length, modified, sha256 of the files, of up to `most` bytes if given; no file is held in memory where its store can be streamed.

    Spark lists no empty files, which `ingest_filter` refuses in any case.
    """
    found = spark.read.format("binaryFile").load(paths)
    found = found if most is None else found.where(F.col("length") <= most)
    listed = found.select("path", "length", F.col("modificationTime").alias("modified"))
    streamed = F.substring_index("path", ":", 1).isin(*STREAMED)
    rest = found.where(~streamed).select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    return streamed_hashes(listed.where(streamed)).unionByName(rest)


def ingest_manifest(spark: SparkSession, paths, customer_id: str | None = None, session_id: str | None = None, device_id: str | None = None, source_type: str | None = None) -> DataFrame:
    """One row per file: path, sha256, size_bytes and the ids.  Files that I6 finds too large aren't read."""
    files = hashed_files(spark, paths, MAX_BYTES)
    customer = customer_id.strip() if customer_id and customer_id.strip() else "anonymous"
    sha = F.col("sha256")
    session = F.lit(session_id) if session_id else F.concat(F.lit("sess_"), F.substring(sha, 1, 16))
    return files.select("path", sha.alias("sha256"), F.col("length").alias("size_bytes"), F.lit(customer).alias("customer_id"), session.alias("session_id"), F.lit(device_id).alias("device_id"), F.lit(source_type).alias("source_type"), F.current_timestamp().alias("ingested_at"))


def ingest_filter(files: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    """Adds reject_reason (null for good files) from path and length alone."""
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    reason = F.when(~suffix.isin(*EXTENSIONS), "EXTENSION_NOT_ALLOWED").when(F.col("length") == 0, "EMPTY_FILE").when(F.col("length") > most, "FILE_TOO_LARGE")
    return files.withColumn("reject_reason", reason)


#: Records of one JSON array.
ARRAY_RECORDS = 100_000


def write_normalized(df: DataFrame, spec: SensorSpec, path: str, fmt: str = "parquet") -> None:
    """Canonical field order; `jsonl` has an object per line, `json` an array per file of up to `ARRAY_RECORDS` records."""
    out = df.select(*spec.fields)
    if fmt == "csv":
        out.write.option("header", True).option("nullValue", "").csv(path)
    elif fmt == "jsonl":
        out.write.option("ignoreNullFields", False).json(path)
    elif fmt == "json":
        numbered = out.select(F.monotonically_increasing_id().alias("i"), F.struct(*spec.fields).alias("row"))
        arrays = numbered.groupBy(F.floor(F.col("i") / F.lit(ARRAY_RECORDS)).alias("file")).agg(F.array_sort(F.collect_list(F.struct("i", "row"))).alias("rows"))
        text = F.to_json(F.transform("rows", lambda r: r["row"]), {"ignoreNullFields": "false"})
        arrays.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    else:
        out.write.parquet(path)


def write_splits_jsonl(samples: DataFrame, path: str) -> None:
    """I8: one set per split, in sample order."""
    samples.sortWithinPartitions("session_id", "k").write.partitionBy("split").option("ignoreNullFields", False).json(path)


def splits_table(samples: DataFrame) -> DataFrame:
    """The five stable columns and the split."""
    rest = [c for c in samples.columns if c != "split"]
    return samples.select("sample_id", F.col("k").alias("window_index"), F.col("start_us").alias("start_timestamp"), F.col("end_us").alias("end_timestamp"), F.to_json(F.struct(*rest)).alias("sample_json"), "split")


def write_splits_parquet(samples: DataFrame, path: str) -> None:
    """I9."""
    splits_table(samples).write.partitionBy("split").parquet(path)
