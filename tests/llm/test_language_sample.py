"""A long text early in hash order must not shut the other training texts out of the sample."""

import zlib

from pyspark.sql import functions as F

from streamcurate.llm import language_id


def test_long_text_first(spark):
    ids = [r.id for r in spark.range(60).orderBy(F.xxhash64("id")).collect() if zlib.crc32(str(r.id).encode()) % language_id.FOLDS != language_id.HELD_OUT]
    for at in (0, 3):
        rows = [(i, "z" * 10_000 if k == at else f"{i:02d}" + "a" * 48, "xx") for k, i in enumerate(ids)]
        got = language_id.training(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 2000, 20)["xx"]
        assert sorted(map(len, got)) == [50] * 19 + [200]
