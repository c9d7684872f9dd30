"""Substring dedup by a sampled suffix array (bytes).

A suffix for every byte would move the text hundreds of times, so suffixes begin at content-sampled
places (window minimisers): every repeated string of 400 bytes holds such a place at the same offset
in both copies.  Each suffix carries the bytes before its place that its windows need.  Copies are
merged first; the sort counts each with its number (see repeats).

Sampled splitters range-partition the suffixes by their leading bytes; a lead with more suffixes than
a bucket takes is cut further, by the bytes that follow.  Each bucket sorts its suffixes, and the
reversed contexts before them, by multikey quicksort on 8-byte symbols; common-prefix lengths of
neighbours tell which windows are equal.  A lead that goes on in the next bucket is compared across
the boundary: of the leads at both ends of each bucket, those that two buckets name have their
windows brought together.

Defined cases: a null text has no bytes; texts shorter than a window keep everything; repeated rows
repeat each other; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scrap, whole_groups
from .repeats import FOUND, Spec, exact_windows, found_rows, intervals_from, keyed, merged, repeated_intervals, with_intervals

WINDOW = 400
GRAM = 64
#: Suffixes of a bucket, about.
BUCKET = 50_000


def padded(strings: list[bytes], width: int) -> np.ndarray:
    """Rows of `width` bytes, zero-filled."""
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)


def multikey_order(rows: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of byte rows by (group, bytes, length): each step sorts the rows still tied by their next 8 bytes."""
    symbols = rows.view(">u8")
    order = np.argsort(group, kind="stable")
    rank = np.cumsum(np.concatenate(([0], (np.diff(group[order]) != 0).astype(np.int64))))
    open_ = np.arange(len(order))
    for c in range(symbols.shape[1] + 1):
        tied = np.zeros(len(open_), bool)
        same = rank[open_[1:]] == rank[open_[:-1]]
        adjacent = open_[1:] == open_[:-1] + 1
        tied[1:] |= same & adjacent
        tied[:-1] |= same & adjacent
        open_ = open_[tied]
        if not len(open_):
            break
        who = order[open_]
        value = symbols[who, c].astype(np.uint64) if c < symbols.shape[1] else lengths[who].astype(np.uint64)
        step = np.lexsort((value, rank[open_]))
        order[open_] = who[step]
        sorted_value, old = value[step], rank[open_]
        new = np.zeros(len(open_), np.int64)
        fresh = np.concatenate(([True], (old[1:] != old[:-1]) | (sorted_value[1:] != sorted_value[:-1])))
        new = open_[fresh][np.cumsum(fresh) - 1]
        # a place in `order` names its group from here on; untouched groups keep smaller, unequal names
        if c == 0:
            rank = np.arange(len(order))
        rank[open_] = new
    return order


def neighbours(rows: np.ndarray, lengths: np.ndarray, group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common-prefix length of each ordered row and the one before it, -1 at the start of a group."""
    a, b = order[1:], order[:-1]
    differ = rows[a] != rows[b]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    common = np.minimum(first, np.minimum(lengths[a], lengths[b]))
    common[group[a] != group[b]] = -1
    return np.concatenate(([-1], common))


def repeated_windows(bodies: list[bytes], offset: np.ndarray, count: np.ndarray, group: np.ndarray, copies: np.ndarray, spec: Spec) -> np.ndarray:
    """Flags (suffix, bytes before its place at a window's start) of windows that the group's suffixes hold more than once, copies counted."""
    W, reach, size = spec.window, spec.window - spec.gram, len(bodies)
    sides = []
    for texts, width in (([b[o : o + W] for b, o in zip(bodies, offset, strict=True)], W), ([b[:o][::-1] for b, o in zip(bodies, offset, strict=True)], reach)):
        rows, lengths = padded(texts, max(8, -(-width // 8) * 8)), np.array([len(t) for t in texts])
        order = multikey_order(rows, lengths, group)
        sides.append((order, neighbours(rows, lengths, group, order)))
    flags = np.zeros((size, reach + 1), bool)
    low, high = offset - count + 1, offset
    for d in range(reach + 1):
        who = np.flatnonzero((low <= d) & (d <= high))
        if not len(who):
            continue
        name = np.zeros(size, np.int64)
        for (order, common), need in ((sides[0], W - d), (sides[1], d)):
            label = np.empty(size, np.int64)
            label[order] = np.cumsum(common < need)
            name = name * (size + 1) + label
        by = who[np.argsort(name[who], kind="stable")]
        first = np.flatnonzero(np.concatenate(([True], name[by][1:] != name[by][:-1])))
        total = np.add.reduceat(copies[by], first)
        flags[by, d] = np.repeat(total > 1, np.diff(np.concatenate((first, [len(by)]))))
    return flags


def suffix_buckets(classes: DataFrame, spec: Spec, bucket: int = BUCKET) -> DataFrame:
    """FOUND: repeated windows from buckets of the sampled suffix array, then leads that cross a boundary."""

    def run(batches):
        ends: list[int] = []
        for part in whole_groups(batches, "fp"):
            columns = [part.column(c).to_numpy() for c in ("fp", "seg", "n", "key", "doc", "place")]
            fp, _, n, _, _, places = columns
            ends = [*ends[:1], int(fp[0]), int(fp[-1])]
            group, size = np.unique(fp, return_inverse=True, return_counts=True)[1:]
            # a lead with one suffix, without copies, has nothing to be compared with here
            use = np.flatnonzero((size[group] > 1) | (n > 1))
            rows = []
            if len(use):
                bodies = part.column("body").take(pa.array(use)).to_pylist()
                count, offset = (places[use] >> 12) & 4095, places[use] & 4095
                flags = repeated_windows(bodies, offset, count, group[use], n[use], spec)
                for i in np.flatnonzero(flags.any(axis=1)):
                    own = flags[i, offset[i] - count[i] + 1 : offset[i] + 1][::-1]
                    rows += [(*(int(c[use[i]]) for c in columns), lo, hi, None) for lo, hi in intervals_from(own, 0, spec.window)]
            yield table(rows)
        yield table([(*[None] * 8, x) for x in set(ends)])

    def table(rows):
        end = pa.array([r[-1] for r in rows], pa.int64())
        return pa.RecordBatch.from_arrays([*found_rows(rows).columns, end], [*found_rows([]).schema.names, "end"])

    spark = classes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-classes.count() // bucket))
    split = F.col("place").bitwiseAND(F.lit(4095)).cast("int")
    rows = classes.select("fp", "seg", "n", "key", "doc", "place", "body", split.alias("at"))
    lead, rest = F.expr(f"substring(body, at + 1, {spec.gram})"), F.expr(f"substring(body, at + 1 + {spec.gram}, {spec.gram})")
    keys = [lead]
    large = materialize(classes.groupBy("fp").agg(F.count("*").alias("m")).where(F.col("m") > bucket).select("fp", F.lit(True).alias("large")), "large")
    if large.take(1):
        rows = rows.join(large, "fp", "left")
        keys += [F.when(F.col("large"), rest), F.when(F.col("large"), F.xxhash64("body", "at"))]
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(lead, "fp").select("fp", "seg", "n", "key", "doc", "place", "body")
    local = materialize(dealt.mapInArrow(run, FOUND + ", end long"), "buckets")
    crossing = local.where("end is not null").groupBy("end").agg(F.count("*").alias("buckets")).where("buckets > 1").select(F.col("end").alias("fp"))
    across = materialize(classes.join(F.broadcast(crossing), "fp", "left_semi"), "boundaries")  # at most one lead a bucket
    beyond = exact_windows(across, spec)
    found = materialize(local.where("end is null").drop("end").unionByName(beyond), "bucket-spans")
    scrap(local, across, beyond, large)
    return found


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """Remove every byte covered by a string of `window` bytes that also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary).
    """
    spec = Spec("bytes", window, gram)
    docs = keyed(docs)
    rows = with_intervals(docs, repeated_intervals(docs, spec, lambda classes, spec: suffix_buckets(classes, spec, bucket)))

    def finish(batches):
        import zstandard

        press = zstandard.ZstdDecompressor()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            out = []
            for doc_id, blob, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "spans")), strict=True):
                text = press.decompress(blob) if blob else b""
                gone = merged(spans)
                at, kept = 0, []
                for lo, hi in gone:
                    kept.append(text[at:lo])
                    at = hi
                rest = b"".join([*kept, text[at:]])
                out.append((doc_id, len(text), len(text) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), rest))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def query(spark, sf_dir):
    from .common import table

    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")
