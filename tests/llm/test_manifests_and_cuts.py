"""Sharding, Merkle manifests and fill-in-middle against plain Python, on nulls, empties, repeats and clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamcurate.llm import fill_in_middle, merkle, sharding

SHAPE = "doc_id long, text string, lang string, source string, n_chars int, n long, at long, tree long, first long, digest string, proof string, shard int, block long, row long"


def corpus():
    rng = random.Random(12)
    letters = "ab é\n漢🎈1,\t"
    rows = [(None, "x\ny", "en", "a"), (1, None, None, None), (2, "", "en", None), (2, "a\nb", "fr", "b"), (2, "a\nb", "fr", "b"), (2, "a b", "fr", "b"), (3, "<P>", "en", "é"), (4, "x<M>y", "en", "Z"), (5, "é" * 3000, "en", "a")]
    rows += [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))), "en", rng.choice(["a", "a", "a", "b", "", None])) for i in range(10, 90)]
    rows += [(7, "again", "en", "b")] * 40
    return [(*r, len(r[1] or "") if i % 5 else None, 1, 2, 3, 4, "d", "p", 5, 6, 7) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SHAPE).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def tree(leaves, fan):
    """The root, and each leaf's list of (left, right) siblings."""
    nodes, paths = [(x, [i]) for i, x in enumerate(leaves)], [[] for _ in leaves]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), fan):
            run = nodes[at : at + fan]
            for k, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(("".join(x for x, _ in run[:k]), "".join(x for x, _ in run[k + 1 :])))
            above.append((H(*(x for x, _ in run)), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], paths


@pytest.mark.parametrize(("fan", "levels"), [(3, 6), (3, 1), (2, 2), (3, 2)])
def test_manifest(docs, fan, levels):
    rows = [(r[0], r[3], leaf(r[0], r[3], r[2], r[4], r[1])) for r in corpus()]
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    subroots, want = [], []
    for source in sources:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        subroot, paths = tree([r[2] for r in own], fan)
        subroots.append(subroot)
        want.append((subroot, own, paths))
    root, upper = tree(subroots, fan)
    expected = [(r[0], r[2], subroot, root, [*p, *up]) for (subroot, own, paths), up in zip(want, upper, strict=True) for r, p in zip(own, paths, strict=True)]
    leaves = docs.select("*", merkle.leaf_of(*map(F.col, merkle.FIELDS)).alias("leaf"))
    got = merkle.manifest(leaves, fan, levels).withColumn("again", merkle.folded())
    assert got.columns == [c for c in docs.columns if c != "proof"] + ["leaf", "subroot", "root", "proof", "again"]
    found = got.collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in found), key=str) == sorted(expected, key=str)
    assert all(r.again == root and (r.n, r.at, r.tree, r.first, r.digest, r.row) == (1, 2, 3, 4, "d", 7) for r in found)


def test_tampering(docs):
    leaves = docs.select("doc_id", "source", merkle.leaf_of(*map(F.col, merkle.FIELDS)).alias("leaf"), merkle.tampered_leaf().alias("tampered"))
    rows = merkle.manifest(leaves).withColumn("shown", F.coalesce("tampered", "leaf")).withColumn("folded_root", merkle.folded("shown")).collect()
    changed = {leaf(r[0], r[3], r[2], r[4], r[1]) for r in corpus() if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[1] or "")}
    assert changed and {r.leaf for r in rows if r.folded_root != r.root} == changed


def plain_shard(doc_id, tree):
    name = "" if doc_id is None else str(doc_id)
    draw = lambda child, weight: math.log((int(hashlib.md5(f"{name}@{child}".encode()).hexdigest()[:13], 16) + 1) / 16**13) / weight
    weigh = lambda x: sum(map(weigh, x.values())) if isinstance(x, dict) else x
    region = max(tree, key=lambda r: draw(r, weigh(tree[r])))
    rack = max(tree[region], key=lambda k: draw(k, weigh(tree[region][k])))
    return max(tree[region][rack], key=lambda s: draw(f"shard{s}", tree[region][rack][s]))


def test_sharding(docs):
    tree, grown = sharding.tree_of(6, regions=2, racks=2), sharding.tree_of(7, 6, regions=2, racks=2)
    got = sharding.assign(docs, tree, grown).collect()
    want = []
    for r in corpus():
        text = (r[1] or "").encode()
        want.append((r[0], len(text) + 16, zlib.crc32(text), "key", plain_shard(r[0], tree), plain_shard(r[0], grown)))
    assert sorted(((*r[:5], r[6]) for r in got), key=str) == sorted(want, key=str)
    for shard, n in Counter(r.shard for r in got).items():
        own = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(n))
        assert [(r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in own] == sorted((r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in own)
    assert sum(r.n_rows for r in sharding.movement(sharding.assign(docs, tree, grown)).collect()) == sum(a[4] != a[5] for a in want)


def test_growth_and_confinement(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    at = lambda *trees: ids.select(*[sharding.shard_of(F.col("doc_id"), t).alias(f"s{i}") for i, t in enumerate(trees)]).collect()
    # each later shard, whatever the count, takes rows only into itself, about its share
    for count in (40, 41, 43):
        rows = at(sharding.tree_of(count, 40), sharding.tree_of(count + 1, 40))
        moved = [r for r in rows if r.s0 != r.s1]
        assert {r.s1 for r in moved} == {count} and abs(len(moved) / 4000 - 1 / (count + 1)) < 0.015
    # a weight that changes inside a rack moves rows between regions only into or out of that one
    tree = sharding.tree_of(24, regions=3, racks=2)
    heavier = sharding.added(tree, 24, 3.0, "region1", "region1/rack0")
    home = {s: (region, rack) for region, racks in heavier.items() for rack, shards in racks.items() for s in shards}
    moved = [(home[r.s0], home[r.s1], r.s0, r.s1) for r in at(tree, heavier) if r.s0 != r.s1]
    assert moved and all(b[0] == "region1" for _, b, _, _ in moved)
    assert all(b[1] == "region1/rack0" for a, b, _, _ in moved if a[0] == "region1")
    assert all(new == 24 for a, b, _, new in moved if a[1] == b[1])
    # shares follow weights, and a shard of weight 0 gets nothing
    light = sharding.added(sharding.added(tree, 30, 6.0), 31, 0.0)
    share = Counter(r.s0 for r in at(light))
    assert share[31] == 0 and abs(share[30] / 4000 - 6 / 30) < 0.03 and max(share[s] for s in range(24)) < 4000 / 30 * 1.5
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("doc_id"), {})


def plain_cut(doc_id, text):
    t = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(t) + 1) for x in h[:2])
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(t), "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    return (doc_id, len(t), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (doc_id, len(t), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(docs):
    got = fill_in_middle.transform(docs).withColumn("back", fill_in_middle.restored()).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((plain_cut(r[0], r[1]) for r in corpus()), key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert Counter(r.back for r in got) == Counter(r[1] or "" for r in corpus())


@pytest.mark.parametrize("units", ["code_points", "words", "lines"])
def test_units(docs, units):
    """Pieces are whole units, and there are as many as a plain count gives."""
    split = {"code_points": list, "words": lambda t: cut_after(t, " \t\v\f\r\n"), "lines": lambda t: cut_after(t, "\n")}[units]
    texts = [r[1] or "" for r in corpus()]
    wanted = [sorted(((7 * i) % (len(split(t)) + 1), (3 * i) % (len(split(t)) + 1))) for i, t in enumerate(texts)]
    got = fill_in_middle.pieces([t.encode() for t in texts], lambda i, n: wanted[i], units)
    for t, (a, b), (n, x, y, lo, hi) in zip(texts, wanted, got, strict=True):
        own = split(t)
        assert (n, x, y) == (len(own), a, b)
        assert (lo, hi) == (len("".join(own[:a]).encode()), len("".join(own[:b]).encode()))
    forms = fill_in_middle.transform(docs, units=units).withColumn("back", fill_in_middle.restored()).collect()
    assert Counter(r.back for r in forms) == Counter(texts)


def cut_after(text, ends):
    out, held = [], ""
    for c in text:
        held += c
        if c in ends:
            out.append(held)
            held = ""
    return [*out, held] if held else out


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    for size in (0, 1, 63, 64, 65, 1000):
        classes = rng.integers(0, 7, size).astype(np.uint8)
        matrix = fill_in_middle.WaveletMatrix(classes)
        at = np.arange(size + 1)
        for kind in range(7):
            assert (matrix.rank(kind, at) == np.concatenate(([0], np.cumsum(classes == kind)))).all()
        assert (matrix.boundaries((1, 5), at) == np.concatenate(([0], np.cumsum(np.isin(classes, (1, 5)))))).all()
        assert (matrix.boundaries((1, 2, 3, 4, 5, 6), at) == np.concatenate(([0], np.cumsum(classes > 0)))).all()


def test_empty_tables(empty):
    assert sharding.assign(empty, sharding.tree_of(3)).collect() == fill_in_middle.transform(empty).collect() == []
    assert merkle.manifest(empty.select("*", F.lit("x").alias("leaf"))).collect() == []
