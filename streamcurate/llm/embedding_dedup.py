"""Embedding near-dedup by cross-polytope hashing.

Vectors are rotated by three rounds of random signs and a fast Hadamard transform; the hash of a
rotation is its largest coordinate with sign.  A table's bucket joins several rotations; each vector
goes to its own bucket and to the likeliest others (multiprobe).  Inside a bucket, and only among
equal labels, pairs are verified by cosine in double precision.  A pair that meets in several buckets
counts in the one of smallest name, so tasks return sums and spanning trees, never all pairs.

Rotations per bucket follow from the rows of the largest label, so that buckets don't grow with the
corpus; more rotations come with more tables and probes, which keep the recall (`SCHEMES`).

Defined cases: vectors that are null, empty or zero or hold null or non-finite components, and null
labels, link with nothing and are kept; equal vectors of a label form one class (pre-aggregation), its
copies linking with each other; vectors of another length than the commonest go to buckets of their own
length; an empty table gives an empty result; a null vec_id stays null and counts as the largest; other
columns are ignored.  Classes are grouped by the vectors themselves; a row finds its class by 128 bits of hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, scrap, table, whole_groups
from .ngram_join import blocked, roots_of

THRESHOLD = 0.93
#: (tables, probes of each) for so many rotations per bucket; recall at the threshold is tested for each.
SCHEMES = {2: (6, 4), 3: (12, 8), 4: (24, 16)}
#: Vectors of a label that a bucket should hold on average, at most.
BUCKET_ROWS = 1024
BLOCK = 4096
SUB_BLOCK = 512
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (a power of two long), normalised."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, which: int) -> np.ndarray:
    rng = np.random.default_rng([977, which])
    for _ in range(ROUNDS):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


def rotations_for(rows: int, width: int) -> int:
    """Rotations per bucket for the rows of a label and the vectors' padded length."""
    found = min(SCHEMES)
    while found < max(SCHEMES) and rows > BUCKET_ROWS * (2 * width) ** found:
        found += 1
    return found


def buckets(vectors: np.ndarray, rotations: int = 2) -> np.ndarray:
    """Bucket names (row, tables * probes): for each table the own bucket and the likeliest others."""
    tables, probes = SCHEMES[rotations]
    n, d = vectors.shape
    width = 1 << max(0, (d - 1).bit_length())
    x = np.zeros((n, width))
    x[:, :d] = vectors
    out = []
    per = min(width, 4)
    for t in range(tables):
        code, cost = np.full((n, 1), t, np.int64), np.zeros((n, 1))
        for k in range(rotations):
            y = rotated(x, rotations * t + k)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :per]
            value = np.take_along_axis(y, top, axis=1)
            code = (code[:, :, None] * (2 * width) + (2 * top + (value < 0))[:, None, :]).reshape(n, -1)
            cost = (cost[:, :, None] + ((np.abs(value[:, :1]) - np.abs(value)) ** 2)[:, None, :]).reshape(n, -1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        names = np.take_along_axis(code, best, axis=1)
        if names.shape[1] < probes:
            names = np.concatenate([names] + [names[:, :1]] * (probes - names.shape[1]), axis=1)
        out.append(names)
    return np.concatenate(out, axis=1)


def usable(vector: str = "embedding"):
    """Whether a vector can link: it has components, all finite, and one that isn't zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def hashed(classes: DataFrame, most: int) -> DataFrame:
    """Adds unit vectors (array<double>) and bucket names to the classes; most: rows of the largest label."""
    schema = "key long, label long, copies long, unit array<double>, names array<long>"

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            by_length: dict[int, list] = {}
            for r in rows:
                by_length.setdefault(len(r["embedding"]), []).append(r)
            for some in by_length.values():
                x = np.array([r["embedding"] for r in some], np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                names = buckets(x, rotations_for(most, 1 << max(0, (x.shape[1] - 1).bit_length())))
                arrays = [pa.array([r[c] for r in some], pa.int64()) for c in ("key", "label", "copies")]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(x), pa.list_(pa.float64())), pa.array(list(names), pa.list_(pa.int64()))], ["key", "label", "copies", "unit", "names"])

    return classes.select("key", "label", "copies", "embedding").mapInArrow(run, schema)


def bucket_links(dealt: DataFrame, threshold: float) -> DataFrame:
    """key, links, root: what the pairs that a task owns add up to."""

    def run(batches):
        for part in whole_groups(batches, "task", 4000):
            tasks = part.column("task").to_numpy()
            edges = np.concatenate(([0], np.flatnonzero(np.diff(tasks)) + 1, [len(tasks)]))
            keys, copies, side, bucket = (part.column(c).to_numpy() for c in ("key", "copies", "side", "bucket"))
            # tasks differ in the length of their vectors and of their names
            flat = [(np.array(lists.flatten()), np.concatenate(([0], np.cumsum(np.array(lists.value_lengths()))))) for lists in (part.column(c).combine_chunks() for c in ("unit", "names"))]
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hi - lo < 2:
                    continue
                unit, names = (values[at[lo] : at[hi]].reshape(hi - lo, -1) for values, at in flat)
                i, j = [], []
                across = side[lo] > 0
                left, right = (np.flatnonzero(side[lo:hi] == s) for s in ((1, 2) if across else (0, 0)))
                for a0 in range(0, len(left), SUB_BLOCK):
                    for b0 in range(0 if across else a0, len(right), SUB_BLOCK):
                        a, b = left[a0 : a0 + SUB_BLOCK], right[b0 : b0 + SUB_BLOCK]
                        close = unit[a] @ unit[b].T >= threshold
                        if not across and a0 == b0:
                            close = np.triu(close, 1)
                        x, y = np.nonzero(close)
                        for at in range(0, len(x), 20_000):
                            p, q = a[x[at : at + 20_000]], b[y[at : at + 20_000]]
                            shared = np.full(len(p), np.iinfo(np.int64).max)
                            for c in range(names.shape[1]):
                                mine = names[p, c]
                                met = (mine[:, None] == names[q]).any(axis=1)
                                shared = np.where(met, np.minimum(shared, mine), shared)
                            owned = shared == bucket[lo]
                            i.append(p[owned])
                            j.append(q[owned])
                if not i or not sum(map(len, i)):
                    continue
                i, j = np.concatenate(i), np.concatenate(j)
                size = hi - lo
                root = roots_of(size, i, j)
                total = np.bincount(i, copies[lo:hi][j], minlength=size) + np.bincount(j, copies[lo:hi][i], minlength=size)
                keep = total > 0
                out.append((keys[lo:hi][keep], total[keep].astype(np.int64), keys[lo:hi][root][keep]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[c] for x in out])) for c in range(3)], ["key", "links", "root"])

    return dealt.mapInArrow(run, "key long, links long, root long")


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    able = F.col("label").isNotNull() & usable()
    rows = rows.select("vec_id", *(F.when(able, F.xxhash64(*parts)).alias(name) for name, parts in (("h1", ["label", "embedding"]), ("h2", [F.lit("second"), "label", "embedding"]))), able.alias("able"), "label", "embedding")
    classes = rows.where("able").groupBy("h1", "h2", "label", "embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    # written at once, so that the numbers stay
    classes = materialize(classes.withColumn("key", F.monotonically_increasing_id()), "vectors")
    most = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    points = materialize(hashed(classes, most), "points")
    # buckets are joined with keys alone; vectors follow for the places that share a bucket
    placed = points.select("key", "label", F.size("unit").alias("dim"), F.explode(F.array_distinct("names")).alias("bucket"))
    on = ["label", "dim", "bucket"]
    # written first, so that a bucket of very many vectors can be split in the join
    sizes = materialize(placed.groupBy(*on).agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    found = placed.join(sizes, on).withColumn("grp", F.xxhash64(*on))
    # vectors of one length only share a task, so they stack
    lean = blocked(found, "grp", "size", "key", block).select("task", "dim", "side", "bucket", "key")
    dealt = lean.join(points.select("key", "copies", "unit", "names"), "key")
    links = materialize(bucket_links(dealt.repartition("dim", "task").sortWithinPartitions("task"), threshold), "links")
    total = links.groupBy("key").agg(F.sum("links").alias("links"))
    component = connected_components(links.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "component")
    heads = points.select("key").join(total, "key", "left").join(component, "key", "left").join(classes.select("key", "h1", "h2", "low", "copies"), "key")
    heads = materialize(heads.select("key", "h1", "h2", "low", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "key").alias("component")), "heads")
    lows = heads.groupBy("component").agg(F.min("low").alias("component_id"))
    full = heads.join(lows, "component").select("h1", "h2", "copies", "links", "component_id")
    out = rows.select("vec_id", "h1", "h2").join(full, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
    )
    out = materialize(out, "linked")
    scrap(classes, points, sizes, links, heads)
    return out


def query(spark, sf_dir):
    return embedding_dedup(table(spark, sf_dir, "embeddings"))
