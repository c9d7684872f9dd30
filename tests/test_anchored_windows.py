"""First-row-anchored windows of a feed against W2 on the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from streamcurate.operators import windows as wn
from streamcurate.streaming import live

SHAPE = "session_id string, t timestamp, x double"


def test_like_the_batch_windows(spark, tmp_path):
    rng = random.Random(2)
    rows, at = [], {s: 1_700_000_000_000_000 + i * 777_000 for i, s in enumerate("abc")}
    for i in range(240):
        s = rng.choice("abc")
        at[s] += rng.choice([100_000, 400_000, 1_300_000, 5_000_000])
        rows.append((at[s], s, None if i % 11 == 0 else float(i % 37)))
    rows.sort()
    # a row of another session moves the watermark beyond all others
    batches = [rows[i : i + 80] for i in range(0, 240, 80)] + [[(1_800_000_000_000_000, "z", 1.0)], [(1_800_000_100_000_000, "z", 1.0)]]
    source = str(tmp_path / "source")
    frames = []
    for i, part in enumerate(batches):
        df = spark.createDataFrame([(s, t, x) for t, s, x in part], "session_id string, us long, x double").select("session_id", F.timestamp_micros("us").alias("t"), "x")
        df.coalesce(1).write.mode("append").parquet(source)
        frames.append(df)
    feed = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(source)
    conf = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(conf, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out, check = str(tmp_path / "out"), str(tmp_path / "check")
        found = live.anchored_windows(feed, "t", ["x"], 3000, 1000, "10 seconds")
        found.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out).awaitTermination()
    finally:
        spark.conf.unset(conf)
    every = frames[0]
    for df in frames[1:]:
        every = every.union(df)
    batch = wn.time_windows(every.select("session_id", F.unix_micros("t").alias("epoch_us"), "x"), 3000, 1000)
    want = batch.where("session_id <> 'z'").groupBy("session_id", "k").agg(F.count("*").alias("n"), F.avg("x"), F.stddev_pop("x"), F.min("x"), F.max("x")).collect()
    got = spark.read.parquet(out).where("session_id <> 'z'").select("session_id", "k", "row_count", "x_mean", "x_std", "x_min", "x_max").collect()
    assert len(want) > 100 and sorted((r[0], r[1]) for r in got) == sorted((r[0], r[1]) for r in want)
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert tuple(a)[:3] == tuple(b)[:3] and [x for x in a[3:]] == pytest.approx([x for x in b[3:]], abs=1e-9, nan_ok=True)
