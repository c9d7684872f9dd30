"""Running values and positions over long sequences, without one task for a whole sequence.

A sequence is cut into blocks of its order column; what a block needs from those before it comes from
a scan over one summary row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize

#: Values of an integer order column that share a block.
BLOCK = 100_000


def block_of(order: str, size: int = BLOCK) -> Column:
    """The block of a row; rows without an order value share one of their own."""
    return F.coalesce(F.floor(F.col(order) / F.lit(size)), F.lit(-(1 << 62)))


def name_of(keys: list[str]) -> Column:
    """The sequence of a row as text that is never null, so that joins keep sequences without a key."""
    return F.concat_ws("\x01", *(F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys))


def last_before(df: DataFrame, keys: list[str], order: str, value: str, name: str, size: int = BLOCK) -> DataFrame:
    """Adds `name`: the last value that isn't null before each row, in the order of an integer column."""
    rows = df.withColumns({"_name": name_of(keys), "_block": block_of(order, size)})
    past = Window.partitionBy("_name", "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("_name", "_block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
    blocks = Window.partitionBy("_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(blocks)).drop("_end")
    seen = rows.withColumn(name, F.last(value, ignorenulls=True).over(past)).join(carried, ["_name", "_block"])
    return seen.withColumn(name, F.coalesce(name, "_carried")).select(*df.columns, name)


def numbered(df: DataFrame, keys: list[str], order: str, size: int = BLOCK) -> DataFrame:
    """Adds i, a row's number from 0 in the order of an integer column, and n, the rows of its sequence."""
    rows = df.withColumns({"_name": name_of(keys), "_block": block_of(order, size)})
    blocks = Window.partitionBy("_name").orderBy("_block")
    counts = rows.groupBy("_name", "_block").agg(F.count("*").alias("_c"))
    bases = counts.select("_name", "_block", F.coalesce(F.sum("_c").over(blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.sum("_c").over(Window.partitionBy("_name")).alias("n"))
    own = Window.partitionBy("_name", "_block").orderBy(order)
    seen = rows.withColumn("i", F.row_number().over(own).cast("long") - 1).join(bases, ["_name", "_block"])
    return seen.withColumn("i", F.col("i") + F.col("_base")).drop("_name", "_block", "_base")


def positions(df: DataFrame, *order: str) -> DataFrame:
    """Adds position, a row's number from 0 over the whole table: range partitions, and one count of each."""
    dealt = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("_part").agg(F.count("*").alias("_c")).select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("_part").orderBy(*order)
    return dealt.withColumn("position", F.row_number().over(own).cast("long") - 1).join(bases, "_part").withColumn("position", F.col("position") + F.col("_base")).drop("_part", "_base")
