"""Best-fit packing of tokenised documents with large-item matching.

Lengths are whole numbers up to the capacity, so the plan needs only how many pieces there are of
each length: a table of at most 1024 rows, whatever the corpus.  On those counts, pieces above one
third of the capacity are matched first, the longest left with the longest that still fits, at most
two to a sequence; smaller pieces then go, longest first, into the tightest gap that takes them.
Equal sequences are planned together, so the plan's rows grow with the number of different gaps, not
with the pieces.  Each piece finds its place by its number among the pieces of its length, from a
prefix sum over small buckets.

Defined cases: a null or empty text is one piece, the end token; documents longer than the capacity
are cut, the first piece may be shorter; repeated rows are packed each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

CAPACITY = 1024
END = 2
#: Pieces that one numbering task takes, about.
BUCKET_PIECES = 200_000


def encoder(vocabulary: str | None = None, added: bool = True):
    """text -> ids of the byte-level BPE, by the tiktoken form of the same vocabulary (the same ids, faster).

    The added tokens of the JSON form beside it are found inside texts, as the tokenizers library
    does even with add_special_tokens=False; with added=False they are text like any other.
    """
    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    names = added_tokens(os.path.splitext(path)[0] + ".json") if added else {}
    made = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=names)
    if not names:
        return made.encode_ordinary
    return lambda text: made.encode(text, allowed_special="all", disallowed_special=())


#: A blank between two word characters begins a token of the vocabulary's pattern, whatever stands around.
SAFE_CUT = re.compile(r"(?<=\w) (?=\w)")


def ids_of(encode, text: str | None, part: int = 1 << 20) -> np.ndarray:
    """The ids of a whole text as 32-bit numbers; a very long one is encoded in parts cut at safe blanks."""
    out, at = [], 0
    while text and len(text) - at > part and (cut := SAFE_CUT.search(text, at + part)):
        out.append(np.array(encode(text[at : cut.start()]), "<u4"))
        at = cut.start()
    out.append(np.array(encode(text[at:]) if text else [], "<u4"))
    return np.concatenate(out)


def added_tokens(path: str) -> dict[str, int]:
    """text -> id of the added tokens of a tokenizers JSON file; none without the file."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError(f"{path}: added tokens that take in or depend on the text around them can't be split off")
    return {t["content"]: t["id"] for t in tokens}


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = np.append(ids_of(encode, text), np.uint32(end)).astype("<u4")
                n = len(raw)
                first = n % capacity or capacity
                at, piece = 0, 0
                while at < n:
                    stop = at + (first if not piece else capacity)
                    out.append((doc_id, piece, at, stop - at, zlib.crc32(raw[at:stop].tobytes())))
                    at, piece = stop, piece + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths in order) for the given number of pieces of each length."""
    left = {n: c for n, c in counts.items() if c}
    bins: dict[tuple[int, ...], int] = {}
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        fit = bisect.bisect_right(large, capacity - a) - 1
        if fit < 0:
            bins[(a,)] = bins.get((a,), 0) + left.pop(a)
            large.pop()
            continue
        b = large[fit]
        if a == b:
            pairs, odd = divmod(left.pop(a), 2)
            if pairs:
                bins[(a, a)] = bins.get((a, a), 0) + pairs
            if odd:
                left[a] = 1
                large.pop(fit)
                rest = bisect.bisect_right(large, capacity - a) - 1
                if rest < 0:
                    bins[(a,)] = bins.get((a,), 0) + 1
                    del left[a]
                else:
                    b = large[rest]
                    bins[(a, b)] = bins.get((a, b), 0) + 1
                    del left[a]
                    left[b] -= 1
                    if not left[b]:
                        del left[b]
                        large.pop(rest)
            else:
                large.pop(fit)
            continue
        pairs = min(left[a], left[b])
        bins[(a, b)] = bins.get((a, b), 0) + pairs
        for n in (a, b):
            left[n] -= pairs
            if not left[n]:
                del left[n]
                large.remove(n)
    gaps: dict[int, list[tuple[list[int], int]]] = {}
    for lengths, count in bins.items():
        gaps.setdefault(capacity - sum(lengths), []).append((list(lengths), count))
    open_gaps = sorted(gaps)
    for n in sorted(left, reverse=True):
        need = left[n]
        while need:
            at = bisect.bisect_left(open_gaps, n)
            if at == len(open_gaps):
                each = capacity // n
                whole, rest = divmod(need, each)
                for lengths, count in (([n] * each, whole), ([n] * rest, 1 if rest else 0)):
                    if count:
                        gap = capacity - sum(lengths)
                        if gap not in gaps:
                            gaps[gap] = []
                            bisect.insort(open_gaps, gap)
                        gaps[gap].append((lengths, count))
                need = 0
                continue
            gap = open_gaps[at]
            lengths, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                open_gaps.pop(at)
            # as many as fit go into one sequence: after the first, the gap left is tighter than any other
            each = min(gap // n, need)
            used = min(count, need // each)
            for made, many in ((lengths + [n] * each, used), (lengths, count - used)):
                if many:
                    g = capacity - sum(made)
                    if g not in gaps:
                        gaps[g] = []
                        bisect.insort(open_gaps, g)
                    gaps[g].append((made, many))
            need -= used * each
    return [(count, lengths) for g in sorted(gaps) for lengths, count in gaps[g]]


def places(made: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, how many, first sequence, offset): where the pieces of each length go."""
    out, taken, sequence = [], {}, 0
    for count, lengths in made:
        offset = 0
        for n in lengths:
            out.append((n, taken.get(n, 0), count, sequence, offset))
            taken[n] = taken.get(n, 0) + count
            offset += n
        sequence += count
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = materialize(pieces_of(docs, capacity, end, vocabulary), "pieces")
    by_length = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = max(8, sum(by_length.values()) // BUCKET_PIECES)
    # pieces are dealt by content, so a hot length or document spreads over all buckets
    dealt = made.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    own = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("bucket", "length").agg(F.count("*").alias("n")).select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = dealt.withColumn("own", F.row_number().over(own) - 1).join(offsets, ["bucket", "length"]).withColumn("number", F.col("base") + F.col("own"))
    spots = places(plan(by_length, capacity))
    # for each length the first numbers in rising order: a piece takes the last one not above its own
    steps: dict[int, list] = {}
    for n, first, _count, sequence, offset in spots:
        steps.setdefault(n, []).append((first, sequence, offset))

    def place(batches):
        firsts = {n: np.array([x[0] for x in rows]) for n, rows in steps.items()}
        seqs = {n: np.array([x[1] for x in rows]) for n, rows in steps.items()}
        offs = {n: np.array([x[2] for x in rows]) for n, rows in steps.items()}
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                k = np.searchsorted(firsts[n], number[at], side="right") - 1
                seq[at] = seqs[n][k] + number[at] - firsts[n][k]
                off[at] = offs[n][k]
            kept = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(seq), pa.array(off)], [*kept, "sequence_id", "offset"])

    lean = numbered.select(*made.columns, "number")
    return lean.mapInArrow(place, made.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema)


def query(spark, sf_dir):
    from .common import table

    return pack(table(spark, sf_dir, "documents"))
