"""Hashes of files that are read in pieces."""

import hashlib
import resource

from streamcurate.operators import lineage as ln
from streamcurate.sources import files


def test_hashes(spark, tmp_path):
    texts = {"a.csv": b"a", "b c.json": b"x" * 10_000, "d%e.jsonl": bytes(range(256)) * 99}
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    listed = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("path", "length", "modificationTime AS modified")
    want = sorted((len(data), hashlib.sha256(data).hexdigest()) for data in texts.values())
    assert sorted((r.length, r.sha256) for r in files.streamed_hashes(listed, chunk=7).collect()) == want
    assert sorted(r.found_sha256 for r in ln.file_hashes(spark, str(tmp_path)).collect()) == sorted(x[1] for x in want)
    rows = files.ingest_manifest(spark, str(tmp_path), session_id="s").collect()
    assert sorted((r.size_bytes, r.sha256) for r in rows) == want and {r.session_id for r in rows} == {"s"}


def test_large_file(spark, tmp_path):
    """A sparse file of 3 GB, more than a row can hold, in little memory."""
    with open(tmp_path / "large.csv", "wb") as f:
        f.truncate(3 << 30)
    (tmp_path / "small.csv").write_bytes(b"1")
    listed = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("path", "length", "modificationTime AS modified")
    hashed = files.streamed_hashes(listed)

    def run(frames):
        for frame in frames:
            frame["peak_mb"] = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
            yield frame[["length", "sha256", "peak_mb"]]

    rows = {r.length: r for r in hashed.mapInPandas(run, "length long, sha256 string, peak_mb double").collect()}
    zeros = hashlib.sha256()
    for _ in range(3 << 10):
        zeros.update(bytes(1 << 20))
    assert rows[3 << 30].sha256 == zeros.hexdigest() and rows[1].sha256 == hashlib.sha256(b"1").hexdigest()
    assert max(r.peak_mb for r in rows.values()) < 1000
