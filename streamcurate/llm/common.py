"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; bounds a Python worker's memory.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a private one is made only for a local master."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="spark-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def scrap(*frames: DataFrame) -> None:
    """Delete what `materialize` wrote for these frames, once nothing reads it any more."""
    for df in frames:
        remove(df.sparkSession, df.written_to)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shipped(spark: SparkSession, value):
    """Broadcast an object of one of our classes; call the result on an executor to get it back."""
    from pyspark import cloudpickle

    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def row_key(*columns: str) -> Column:
    """Identity of a row by content: equal rows share it, which is right as they share results."""
    return F.xxhash64(*[F.col(c) for c in columns])


def whole_row(docs: DataFrame) -> Column:
    """All columns in one struct, where their names can't clash with those of results."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])


def binaries(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def chunked(items: Iterable[tuple], size_of, limit: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Cut a stream into lists of about `limit` bytes; a longer item is a list of its own."""
    held, total = [], 0
    for item in items:
        n = size_of(item)
        if held and total + n > limit:
            yield held
            held, total = [], 0
        held.append(item)
        total += n
    if held:
        yield held


def packed_text(docs: DataFrame, *keep: str, once: str | None = None) -> DataFrame:
    """The columns `keep` and the text as zstd bytes in `packed` (null text: null), to shuffle less.

    Of rows that are equal in the column `once` each task gives the first only.
    """
    schema = docs.select(*keep).schema.add("packed", "binary")

    def pack(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        seen: set = set()
        for batch in batches:
            if once:
                fresh = [k not in seen and not seen.add(k) for k in batch.column(once).to_pylist()]
                batch = batch.filter(pa.array(fresh, pa.bool_()))
            data = [None if t is None else press.compress(t) for t in binaries(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(data, pa.binary())], [*keep, "packed"])

    return docs.select(*keep, "text").mapInArrow(pack, schema)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, at_least: int = 20_000) -> Iterator[pa.Table]:
    """From batches sorted by `key`, tables that hold whole groups, of about `at_least` rows."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held.append(part)
        rows += part.num_rows
        if rows < at_least:
            continue
        keys = part.column(key)
        last = keys[part.num_rows - 1]
        same = np.asarray(pa.compute.equal(keys, last).to_numpy(zero_copy_only=False))
        cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
        if not cut:
            continue
        held[-1] = part.slice(0, cut)
        yield pa.concat_tables(held).combine_chunks()
        held, rows = [part.slice(cut)], part.num_rows - cut
    if held:
        yield pa.concat_tables(held).combine_chunks()


def placed(df: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds `first` (rows of the groups before, ascending, null first), `n` (rows of the group), `at` (place in it, from 0).

    One range exchange and a count for each of its partitions: no task holds a whole group, and rows
    equal in every column of the order (they take any order) are dealt to many tasks as well.
    """
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    by = [group, *order, "_row"]
    # the numbers of sorted partitions: the partition above, the place in it below bit 33
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumns({"_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_row", "_id"), "ranges")
    runs = dealt.groupBy("_part", F.col(group).alias("_group")).agg(F.count("*").alias("_c"), F.min("_place").alias("_low"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.groupBy("_part").agg(F.sum("_c").alias("_rows")).select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    runs = runs.join(bases, "_part")
    groups = runs.groupBy(F.col("_group").alias("_whole")).agg(F.min(F.col("_base") + F.col("_low")).alias("first"), F.sum("_c").alias("n"))
    runs = runs.join(groups, F.col("_group").eqNullSafe(F.col("_whole"))).select(F.col("_part").alias("_of"), "_group", "_base", "first", "n")
    out = dealt.join(runs, (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    out = materialize(out.select(*df.columns, "first", "n", (F.col("_base") + F.col("_place") - F.col("first")).alias("at")), "placed")
    scrap(rows, dealt)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in `edges` (a, b: long); component is its smallest node.

    Every round hooks each node to its smallest neighbour, follows those pointers to their roots by
    repeated doubling, and contracts the edges.  Nothing is collected; each step is written to the
    shared folder.
    """
    spark = edges.sparkSession
    edges = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps = []
    while edges.take(1):
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("up"))
        parent = materialize(parent, "parent")
        while True:
            up = parent.select(F.col("node").alias("mid"), F.col("up").alias("top"))
            jumped = materialize(parent.join(up, F.col("up") == F.col("mid")).select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "jump")
            scrap(parent)
            moved, parent = jumped.where("moved").take(1), jumped
            if not moved:
                break
        maps.append(parent.select("node", "up"))
        pa_, pb = maps[-1].toDF("a", "ra"), maps[-1].toDF("b", "rb")
        older, edges = edges, materialize(edges.join(pa_, "a").join(pb, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        scrap(older)
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    out = maps[0].toDF("node", "component")
    for step in maps[1:]:
        nxt = step.toDF("component", "root")
        out = out.join(nxt, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return out
