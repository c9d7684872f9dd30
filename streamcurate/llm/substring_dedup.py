"""Substring dedup by super-k-mer partitioning (words).

Consecutive windows that share a minimiser travel as one packed string to the bucket of that
minimiser, where sorting the windows counts them exactly.  Before that, minimisers seen once are
dropped and equal strings merged with their number, so what is shuffled follows the repeated part of
the corpus; the sort counts a window as often as its strings occur.  A minimiser with more than `hot` distinct strings isn't given to one task: its windows
are grouped one by one.  Strings decide in every case.

Defined cases: a null or empty text has no words; texts of fewer words than a window keep all of
them; repeated rows repeat each other's windows; an empty table gives an empty result; other columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scrap, whole_groups
from .repeats import FOUND, Spec, exact_windows, found_rows, intervals_from, keyed, merged, repeated_intervals, with_intervals, word_table

WINDOW = 35
GRAM = 8


def word_buckets(classes: DataFrame, spec: Spec) -> DataFrame:
    """FOUND of packed strings, bucket by bucket: sort the windows, add up the numbers of equal ones."""

    def run(batches):
        for part in whole_groups(batches, "fp"):
            columns = [part.column(c).to_numpy() for c in ("fp", "seg", "n", "key", "doc", "place")]
            fp, _, n, _, _, places = columns
            bodies = part.column("body")
            edges = np.flatnonzero(np.diff(np.concatenate(([fp[0] - 1], fp, [fp[-1] - 1]))))
            rows = []
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if high - low == 1 and n[low] == 1:
                    continue  # nothing to count its windows against
                windows, owner = [], []
                for i in range(low, high):
                    body = bodies[i].as_py()
                    start, end = word_table(body)
                    count = (int(places[i]) >> 12) & 4095
                    windows += [body[a:b] for a, b in zip(start[:count].tolist(), end[spec.window - 1 :].tolist(), strict=True)]
                    owner += [(i, j) for j in range(count)]
                flags = {i: np.zeros((int(places[i]) >> 12) & 4095, bool) for i in range(low, high)}
                for _, equal in groupby(sorted(range(len(windows)), key=windows.__getitem__), key=windows.__getitem__):
                    held = [owner[a] for a in equal]
                    if sum(int(n[i]) for i, _ in held) > 1:
                        for i, j in held:
                            flags[i][j] = True
                rows += [(*(int(c[i]) for c in columns), lo, hi) for i, f in flags.items() for lo, hi in intervals_from(f, 0, spec.window)]
            yield found_rows(rows)

    large = materialize(classes.groupBy("fp").agg(F.count("*").alias("m")).where(F.col("m") > spec.hot).select("fp"), "large")
    some = bool(large.take(1))
    few = classes.join(large, "fp", "left_anti") if some else classes
    found = few.select("fp", "seg", "n", "key", "doc", "place", "body").repartition("fp").sortWithinPartitions("fp").mapInArrow(run, FOUND)
    hot = exact_windows(classes.join(large, "fp", "left_semi"), spec) if some else None
    out = materialize(found.unionByName(hot) if some else found, "bucket-spans")
    scrap(large, *([hot] if some else []))
    return out


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = 20_000) -> DataFrame:
    """Remove every word covered by a window of `window` words that also starts elsewhere.

    Returns doc_id, n_words, n_removed, kept_sha256, kept_text.
    """
    spec = Spec("words", window, gram, hot)
    docs = keyed(docs)
    rows = with_intervals(docs, repeated_intervals(docs, spec, word_buckets))

    def finish(batches):
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc_id, blob, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "spans")), strict=True):
                words = press.decompress(blob).split() if blob else []
                total = len(words)
                if spans:
                    keep = bytearray(b"\1") * total
                    for lo, hi in merged(spans):
                        keep[lo:hi] = bytes(hi - lo)
                    words = list(compress(words, keep))
                kept = b" ".join(words)
                out.append((doc_id, total, total - len(words), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))] + [pa.array([r[4] for r in out], pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return rows.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def query(spark, sf_dir):
    from .common import table

    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text")
