"""Where intermediate tables go: the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="spark-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Written once and read back, so that several reports share one computation."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what `materialize` wrote for these frames, once nothing reads it any more."""
    for df in frames:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
