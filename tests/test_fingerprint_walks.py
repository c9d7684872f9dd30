"""Roots with one arrow up share a walk; fingerprints follow from all that lies above."""

import hashlib
import random

from streamcurate.operators import lineage as ln


def test_shared_walks(spark, monkeypatch):
    rng = random.Random(3)
    ups = {i: sorted({rng.randrange(i) for _ in range(rng.choice([1, 1, 2]))}) if i else [] for i in range(12)}
    ups |= {i: [i % 12] for i in range(12, 60)} | {60: [61], 61: [60], 62: [62]}
    edges = spark.createDataFrame([("x", str(p), "x", str(c)) for c, ps in ups.items() for p in ps], "parent_type string, parent_id string, child_type string, child_id string")
    artifacts = spark.createDataFrame([("x", str(i), f"c{i % 17}") for i in ups if i % 10], "artifact_type string, artifact_id string, content_sha256 string")
    walked, walk = [], ln.walk
    monkeypatch.setattr(ln, "walk", lambda roots, *a: walked.append(roots.count()) or walk(roots, *a))
    roots = [i for i in ups if i > 11]
    got = {r.root: r.fingerprint for r in ln.lineage_fingerprint(spark.createDataFrame([(f"x/{i}",) for i in roots], "root string"), edges, artifacts).collect()}

    def reach(i):
        seen, todo = set(), [i]
        while todo:
            if (n := todo.pop()) not in seen:
                seen.add(n)
                todo += ups[n]
        return {f"x:c{n % 17}" for n in seen if n % 10}

    want = {f"x/{i}": hashlib.sha256("\n".join(sorted(reach(i))).encode()).hexdigest() for i in roots if reach(i)}
    assert got == want
    assert walked == [15]  # 12 nodes above 48 roots, and those of the two rings
