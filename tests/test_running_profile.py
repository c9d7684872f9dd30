"""The running profile after several batches against one profile of all rows; a restart counts nothing twice."""

import math

import pytest

from streamcurate.operators import qc
from streamcurate.streaming import live


def test_restart_and_merge(spark, tmp_path):
    values = [None if i % 13 == 0 else float("nan") if i % 17 == 0 else math.sin(i) * i for i in range(600)]
    rows = spark.createDataFrame([(v, 1.0 if i < 300 else None) for i, v in enumerate(values)], "a double, b double")
    source, folder, check = (str(tmp_path / n) for n in ("source", "state", "check"))
    seen = {}

    def run(fail: bool):
        def sink(df, n):
            seen[n] = {r.path: r for r in df.collect()}
            if fail and n == 2:
                raise RuntimeError("lost")

        feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        live.running_profile(feed, ["a", "b"], folder, sink).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()

    rows.repartition(5).write.parquet(source)
    with pytest.raises(Exception, match="lost"):
        run(fail=True)
    run(fail=False)
    want = {r.path: r for r in qc.feature_profile(qc.long_form(rows, ["a", "b"])).collect()}
    last = seen[max(seen)]
    for path, w in want.items():
        got = last[path]
        assert [got[c] for c in ("total", "present", "nulls", "non_finite", "missing", "min", "max")] == [w[c] for c in ("total", "present", "nulls", "non_finite", "missing", "min", "max")]
        assert got["mean"] == pytest.approx(w["mean"]) and got["std"] == pytest.approx(w["std"], abs=1e-9)
    fine = sorted(v for v in values if v is not None and v == v)
    for p, v in zip(qc.PERCENTILES, last["a"]["percentiles"], strict=True):
        assert abs(sum(x <= v for x in fine) / len(fine) - p) <= 0.01
