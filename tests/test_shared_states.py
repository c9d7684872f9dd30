"""Anchored windows of many sessions that share few states, against W2 on the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from streamcurate.operators import windows as wn
from streamcurate.streaming import live


def test_sessions_share_states(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"s{i % 40}" if i % 40 else None, 1_700_000_000_000_000 + i * 130_000 + rng.randrange(1000), None if i % 40 == 7 or i % 9 == 0 else float(i % 31)) for i in range(2400)]
    end = [[("z", 1_800_000_000_000_000 + i, 1.0)] for i in (0, 1_000_000)]
    source, out, check = (str(tmp_path / x) for x in ("source", "out", "check"))
    every = spark.createDataFrame(rows, "session_id string, us long, x double")
    for part in [rows[:900], rows[900:1000], rows[1000:], *end]:
        df = spark.createDataFrame(part, every.schema).select("session_id", F.timestamp_micros("us").alias("t"), "x")
        df.write.mode("append").parquet(source)
        feed = spark.readStream.schema(df.schema).parquet(source)
        # each part is a run of its own that goes on from the states of the one before
        found = live.anchored_windows(feed, "t", ["x"], 9000, 4000, "5 seconds", buckets=3)
        found.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out).awaitTermination()
    batch = wn.time_windows(every.select(F.coalesce("session_id", F.lit("-")).alias("session_id"), F.col("us").alias("epoch_us"), "x"), 9000, 4000)
    stats = [F.count("*").alias("n"), F.avg("x"), F.stddev_pop("x"), F.min("x"), F.max("x")]
    want = sorted(tuple(r) for r in batch.groupBy("session_id", "k").agg(*stats).collect())
    got = spark.read.parquet(out).where("session_id IS NULL OR session_id <> 'z'").select(F.coalesce("session_id", F.lit("-")), "k", "row_count", "x_mean", "x_std", "x_min", "x_max")
    got = sorted(tuple(r) for r in got.collect())
    assert len(want) > 1000 and [r[:3] for r in got] == [r[:3] for r in want]
    for a, b in zip(got, want, strict=True):
        assert [x is None for x in a] == [x is None for x in b]
        assert [x for x in a[3:] if x is not None] == pytest.approx([x for x in b[3:] if x is not None], abs=1e-9)
