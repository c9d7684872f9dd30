"""T2 on a feed whose rows come in another order than their record numbers."""

from streamcurate.streaming import live

SHAPE = "session_id string, stream string, record_number long, epoch_us long"


def test_order_inside_a_batch_is_that_of_record_numbers(spark, tmp_path):
    # two micro-batches; a session's rows lie in several files of each, the later ones first
    times = [(i // 2 if i % 7 else i - 5) for i in range(400)]
    source = str(tmp_path / "source")
    frame = lambda numbers: spark.createDataFrame([(s, "all", i, times[i]) for i in numbers for s in "ab"], SHAPE)
    got = []
    for n, (lo, hi) in enumerate([(0, 200), (200, 400)]):
        for part in range(3, -1, -1):
            frame([i for i in reversed(range(lo, hi)) if i % 4 == part]).coalesce(1).write.mode("append").parquet(source)
        feed = spark.readStream.schema(SHAPE).parquet(source)
        out = str(tmp_path / "out")
        found = live.order_check(feed).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check"))
        found.trigger(availableNow=True).start().awaitTermination()
        got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    code = {1: "TIMESTAMP_OUT_OF_ORDER", 0: "DUPLICATE_TIMESTAMP"}
    want = [(s, "all", i, code[int(times[i] < times[i - 1])]) for s in "ab" for i in range(1, 400) if times[i] <= times[i - 1]]
    assert len(want) > 100 and got == sorted(want)
