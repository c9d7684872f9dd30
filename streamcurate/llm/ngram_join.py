"""N-gram Jaccard join by MinHash banding.

Texts with equal n-gram sets form one class (pre-aggregation), so copies travel once.  Of each class
a MinHash signature is cut into bands; band and row counts come from the target recall at the
threshold.  Classes that share a band hash are candidates; the groups that such sharing connects are
brought together, and pairs inside are verified on the full n-gram sets, if and only if they share
a band.  Large groups are cut into blocks whose pairs go to separate tasks; groups of more blocks than
there are bands are dealt by band hash instead, where a pair counts in the first band it shares, so no
row travels more often than there are bands or blocks of one band hash.  Tasks return sums and spanning
trees, never all pairs.

Defined cases: a text of fewer words than n is one n-gram of all its words; a null text or one
without words links with nothing and is kept; repeated rows are copies that link with each other; ties keep the
smallest doc_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, binaries, connected_components, materialize, packed_text, row_key, scrap, table, whole_groups, whole_row
from .repeats import BASE, BYTE_VALUES, mix, prefix, spans_hash

N = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Classes of a group that one task compares at once.
BLOCK = 4096
#: Rows of one matrix product, and cells of one sparse step.
SUB_BLOCK, CELLS = 1024, 1 << 22
#: Words: ASCII digits and letters and everything beyond ASCII; the rest separates.
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def bands_for(threshold: float, recall: float, most: int = 256) -> tuple[int, int]:
    """(bands, rows) with the most rows a band such that a pair at the threshold meets with `recall`."""
    best = (most, 1)
    for rows in range(1, 20):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most // 2:
            best = (bands, rows)
    return best


def words_in_parts(text: bytes, limit: int = CHUNK_BYTES):
    """Lists of the lower-cased words of a text, cut between words about every `limit` bytes."""
    at = 0
    while at < len(text):
        stop = SEPARATOR.search(text, at + limit) if len(text) - at > limit else None
        stop = stop.start() if stop else len(text)
        yield WORDS.findall(text[at:stop].lower())
        at = stop


def shingles(text: bytes | None, n: int = N, limit: int = CHUNK_BYTES) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    found, held = [], []
    for words in words_in_parts(text or b"", limit):
        held += words
        if len(held) >= n:
            found.append(grams_of(held, n))
            held = held[len(held) - n + 1 :]
    if not found and held:
        return grams_of(held, len(held))
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0] if found else np.zeros(0, np.uint64)


def grams_of(words: list[bytes], n: int) -> np.ndarray:
    data = b" ".join(words)
    ends = np.cumsum(np.array([len(w) + 1 for w in words])) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    value = mix(spans_hash(prefix(BYTE_VALUES[np.frombuffer(data, np.uint8)]), starts, ends) + (ends - starts).astype(np.uint64))
    at = np.arange(len(words) - n + 1)
    return np.unique(mix(spans_hash(prefix(value), at, at + n)))


class MinHash:
    """One 64-bit hash per band from the minima of bands * rows hash functions."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20240229)
        self.shape = bands, rows
        self.a = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.factors = np.array([pow(BASE, i + 1, 1 << 64) for i in range(rows)], np.uint64)

    def of(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(grams), 1024):
            x = grams[None, at : at + 1024] * self.a[:, None]
            x += self.b[:, None]
            x ^= x >> np.uint64(29)
            np.minimum(low, x.min(axis=1), out=low)
        bands, rows = self.shape
        return mix((mix(low).reshape(bands, rows) * self.factors).sum(axis=1) + np.arange(bands, dtype=np.uint64))


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """key, doc_id, class (hash of the n-gram set, null without words), bands."""
    schema = "key long, doc_id long, class long, bands array<long>"

    def run(batches):
        hashes = MinHash(bands, rows)
        for batch in batches:
            classes, sigs = [], []
            for text in binaries(batch.column("text")):
                found = shingles(text, n)
                if not len(found):
                    classes.append(None)
                    sigs.append(None)
                    continue
                with np.errstate(over="ignore"):
                    classes.append(int(mix(np.array([mix(found + np.uint64(BASE)).sum() + np.uint64(len(found))]))[0].view(np.int64)))
                    sigs.append(hashes.of(found).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), pa.array(classes, pa.int64()), pa.array(sigs, pa.list_(pa.int64()))], ["key", "doc_id", "class", "bands"])

    return docs.select("key", "doc_id", "text").mapInArrow(run, schema)


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of `a` with each of `b`.

    Elements common to many sets go through a matrix product, the others through their short lists.
    """
    out = np.zeros((len(a), len(b)), np.float32)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    row_a, row_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    both = np.intersect1d(flat_a, flat_b)
    if not len(both):
        return out
    keep_a, keep_b = np.isin(flat_a, both), np.isin(flat_b, both)
    ids_a, ids_b = np.searchsorted(both, flat_a[keep_a]), np.searchsorted(both, flat_b[keep_b])
    row_a, row_b = row_a[keep_a], row_b[keep_b]
    count_a, count_b = np.bincount(ids_a, minlength=len(both)), np.bincount(ids_b, minlength=len(both))
    dense = count_a * count_b * 64 > len(a) * len(b)
    column = np.cumsum(dense) - 1
    for lo in range(0, int(dense.sum()), 2048):
        hi = min(lo + 2048, int(dense.sum()))
        sides = []
        for ids, row, size in ((ids_a, row_a, len(a)), (ids_b, row_b, len(b))):
            pick = dense[ids] & (column[ids] >= lo) & (column[ids] < hi)
            m = np.zeros((size, hi - lo), np.float32)
            m[row[pick], column[ids[pick]] - lo] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    thin_a, thin_b = ~dense[ids_a], ~dense[ids_b]
    ids_a, row_a, ids_b, row_b = ids_a[thin_a], row_a[thin_a], ids_b[thin_b], row_b[thin_b]
    if len(ids_a):
        by = np.argsort(ids_b, kind="stable")
        ids_b, row_b = ids_b[by], row_b[by]
        first, last = np.searchsorted(ids_b, ids_a), np.searchsorted(ids_b, ids_a, side="right")
        many = last - first
        cuts = np.searchsorted(np.cumsum(many), np.arange(CELLS, int(many.sum()) + CELLS, CELLS))
        for lo, hi in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(many)])), strict=False):
            if lo >= hi:
                continue
            m = many[lo:hi]
            offset = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            cell = np.repeat(row_a[lo:hi], m) * len(b) + row_b[np.repeat(first[lo:hi], m) + offset]
            out += np.bincount(cell, minlength=out.size).reshape(out.shape)
    return out


def linked(sets: list[np.ndarray], bands: np.ndarray, side: np.ndarray, threshold: float, band_no: int = -1):
    """(i, j) arrays of linked pairs: all inside a block, or across the two sides of a pair of blocks.

    With a band number, only pairs for which that band is the first they share.
    """
    pairs_i, pairs_j = [], []
    parts = [np.flatnonzero(side == s) for s in (0, 1, 2)]
    if len(parts[0]):
        jobs = [(parts[0][i : i + SUB_BLOCK], parts[0][j : j + SUB_BLOCK], i == j) for i in range(0, len(parts[0]), SUB_BLOCK) for j in range(i, len(parts[0]), SUB_BLOCK)]
    else:
        jobs = [(parts[1][i : i + SUB_BLOCK], parts[2][j : j + SUB_BLOCK], False) for i in range(0, len(parts[1]), SUB_BLOCK) for j in range(0, len(parts[2]), SUB_BLOCK)]
    size = np.array([len(s) for s in sets], np.float64)
    for a, b, own in jobs:
        meet = np.zeros((len(a), len(b)), bool)
        for k in range(bands.shape[1] if band_no < 0 else band_no):
            meet |= bands[a, k][:, None] == bands[b, k][None, :]
        if band_no >= 0:
            meet = ~meet & (bands[a, band_no][:, None] == bands[b, band_no][None, :])
        if own:
            meet = np.triu(meet, 1)
        # sizes alone rule out what can't reach the threshold
        small, big = np.minimum(size[a][:, None], size[b][None, :]), np.maximum(size[a][:, None], size[b][None, :])
        meet &= small >= threshold * big
        if not meet.any():
            continue
        use_a, use_b = np.flatnonzero(meet.any(axis=1)), np.flatnonzero(meet.any(axis=0))
        if len(use_a) * len(use_b) <= 16:
            for i, j in np.argwhere(meet):
                both = len(np.intersect1d(sets[a[i]], sets[b[j]], assume_unique=True))
                if both >= threshold * (size[a[i]] + size[b[j]] - both):
                    pairs_i.append(np.array([a[i]]))
                    pairs_j.append(np.array([b[j]]))
            continue
        both = overlaps([sets[x] for x in a[use_a]], [sets[x] for x in b[use_b]]).astype(np.float64)
        total = size[a[use_a]][:, None] + size[b[use_b]][None, :] - both
        i, j = np.nonzero(meet[np.ix_(use_a, use_b)] & (both >= threshold * total))
        pairs_i.append(a[use_a][i])
        pairs_j.append(b[use_b][j])
    if not pairs_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(pairs_i), np.concatenate(pairs_j)


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index connected with each index, by label propagation over the pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (before == root).all():
            break
    return root


def blocked(rows: DataFrame, group: str, size: str, key: str, block: int) -> DataFrame:
    """Rows of a group dealt to tasks: `task` names the group and a pair of its blocks, `side` is 0
    for a block paired with itself, 1 and 2 for the blocks of other pairs (one of them may hold no row).

    Groups of up to `block` rows are one task; in larger ones each row meets every block once.
    """
    parts = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(key, F.lit(7)), F.col("parts")).cast("int")
    out = rows.withColumn("parts", parts).withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return out.withColumn("task", F.xxhash64(group, low, high)).withColumn("side", F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2)).drop("own", "other")


def connected(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK, most_parts: int | None = None) -> DataFrame:
    """One row per document: key (of doc_id and text), doc_id, class, copies, links, component, class_id.

    Groups of more than `most_parts` blocks (default: the number of bands) are dealt by band hash.
    """
    count, rows = bands_for(threshold, recall)
    docs = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sigs = materialize(signatures(docs, n, count, rows), "signatures")
    classes = sigs.where("class is not null").groupBy("class").agg(F.count("*").alias("copies"), F.min("doc_id").alias("low"), F.min("key").alias("key"), F.min("bands").alias("bands"))
    classes = materialize(classes, "classes")
    meets = classes.select("class", F.explode("bands").alias("band"))
    # written first, so that a band hash of very many classes can be split in the joins
    heads = materialize(meets.groupBy("band").agg(F.min("class").alias("head"), F.count("*").alias("n")).where("n > 1"), "heads")
    groups = connected_components(meets.join(heads.select("band", "head"), "band").select(F.col("class").alias("a"), F.col("head").alias("b"))).select(F.col("node").alias("class"), F.col("component").alias("grp"))
    groups = materialize(groups, "groups")
    sizes = materialize(groups.groupBy("grp").agg(F.count("*").alias("size")), "sizes")
    wanted = groups.join(sizes, "grp").join(classes, "class").select("class", "grp", "size", "copies", "key", "bands")
    # equal rows share a key: their text comes once from each task that reads them, and only one is used
    texts = packed_text(docs, "key", once="key").join(wanted, "key")
    few = F.col("size") <= block * (count if most_parts is None else most_parts)
    sent = ["task", "side", "parts", "band_no", "class", "copies", "bands", "packed"]
    dealt = blocked(texts.where(few), "grp", "size", "class", block).withColumn("band_no", F.lit(-1)).select(sent)
    if sizes.where(~few).take(1):
        by_band = texts.where(~few).select("*", F.posexplode("bands").alias("band_no", "band")).join(heads.select("band", "n"), "band")
        wide = blocked(by_band, "band", "n", "class", block).withColumn("parts", F.greatest("parts", F.lit(2)))
        dealt = dealt.unionByName(wide.select(sent))
    found = materialize(verified(dealt.repartition("task").sortWithinPartitions("task"), n, threshold), "links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    # a group in one task is settled there; trees of cut groups are joined
    trees = connected_components(found.where("class <> root AND cut").select(F.col("class").alias("a"), F.col("root").alias("b")))
    whole = found.where("NOT cut").select("class", F.col("root").alias("component"))
    component = whole.unionByName(trees.select(F.col("node").alias("class"), "component"))
    named = classes.join(links, "class", "left").join(component, "class", "left").select("class", "copies", "low", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "class").alias("component"))
    named = materialize(named, "named")
    low = named.groupBy("component").agg(F.min("low").alias("class_id"))
    full = named.join(low, "component").select("class", "copies", "links", "component", "class_id")
    out = materialize(sigs.select("doc_id", "class", "key").join(full, "class", "left"), "connected")
    scrap(sigs, classes, heads, groups, sizes, found, named)
    return out


def ngram_join(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_links (other documents linked directly), n_copies, class_id, kept.

    class_id is the smallest doc_id of those that links connect; kept is true where it is the row's own.
    Options as in `connected`.
    """
    return connected(docs, **options).select(
        "doc_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("class_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def verified(dealt: DataFrame, n: int, threshold: float) -> DataFrame:
    """class, links (documents linked in this task), root (class that the task's links connect it with), cut."""

    def run(batches):
        import zstandard

        press = zstandard.ZstdDecompressor()
        for part in whole_groups(batches, "task", 2000):
            tasks = part.column("task").to_numpy()
            edges = np.concatenate(([0], np.flatnonzero(np.diff(tasks)) + 1, [len(tasks)]))
            ids, copies, side, parts, band_no = (part.column(c).to_numpy() for c in ("class", "copies", "side", "parts", "band_no"))
            bands = np.array(part.column("bands").to_pylist(), np.int64).reshape(len(ids), -1)
            out = []
            blobs = part.column("packed")
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                # repeated rows bring a class more than once
                _, first = np.unique(ids[lo:hi], return_index=True)
                at = lo + first
                if len(at) < 2:
                    continue
                sets = [shingles(press.decompress(blobs[int(x)].as_py()), n) for x in at]
                i, j = linked(sets, bands[at], side[at], threshold, int(band_no[lo]))
                own, root = ids[at], roots_of(len(at), i, j)
                total = np.bincount(i, copies[at][j], minlength=len(at)) + np.bincount(j, copies[at][i], minlength=len(at))
                keep = total > 0
                out.append((own[keep], total[keep].astype(np.int64), own[root][keep], parts[at][keep] > 1))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[c] for x in out])) for c in range(4)], ["class", "links", "root", "cut"])

    return dealt.mapInArrow(run, "class long, links long, root long, cut boolean")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, one of each set that links connect: the one with the smallest doc_id.

    Rows are told apart by doc_id and text, so a doc_id may repeat; of rows equal in both, one stays.
    """
    each = connected(docs, **options)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    heads = each.groupBy(F.coalesce("component", "key")).agg(first.alias("head")).select("head.key")
    rows = docs.select(row_key("doc_id", "text").alias("key"), whole_row(docs).alias("row"))
    return rows.join(heads, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def query(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"))
