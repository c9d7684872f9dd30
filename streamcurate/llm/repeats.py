"""Exact repeated windows over whole corpora: what both substring operators share.

A window is W consecutive tokens of one document.  Its minimiser, the K-gram of smallest hash in it,
depends on nothing but the window, so equal windows meet wherever minimisers are brought together:

1. Runs of consecutive windows that share a minimiser occurrence become one row: fingerprint of the
   minimiser, fingerprint of the run's string, place.  Only fingerprints are shuffled.
2. Minimisers that occur once hold no repeated window and go.  This only takes away what can't
   repeat; from here on strings decide, never fingerprints.
3. The strings of all other runs are cut from their texts and grouped as strings, with map-side
   combining, so of copies one string travels on, with their number.
4. The operators sort the windows of the distinct strings, each in its own way, and count them with
   these numbers; what they find in a string holds for all its copies.  Groups too large for one task
   go window by window through `exact_windows`, which compares the windows as strings too.

Places come back as token intervals by document.  A document is named by its doc_id (`doc`, 0 for
null) and a hash of doc_id and text (`key`) together, so repeated doc_ids stay apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, binaries, chunked, materialize, packed_text, row_key, scrap

#: Odd multipliers of the rolling hash and its mixer; any odd 64-bit values do.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93
#: Bits of a position inside a chunk of tokens.
POSITION_BITS = 27
#: A run is heavy if it holds more than one in HEAVY of the rows joined.
HEAVY = 1000
#: What is found in a distinct string: tokens [lo, hi) of it; key, doc and place are those of one copy.
FOUND = "fp long, seg long, n long, key long, doc long, place long, lo long, hi long"


@dataclass(frozen=True)
class Spec:
    """tokens: "words" or "bytes"; window and gram in tokens; hot: distinct strings a task may take."""

    tokens: str
    window: int
    gram: int
    hot: int = 20_000


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(MIX)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(MIX)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of BASE and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int):
        if len(self.up) <= n:
            size = max(n + 1, 1 << 20)
            inverse = pow(BASE, -1, 1 << 64)
            for name, base in (("up", BASE), ("down", inverse)):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


POWERS = Powers()
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def prefix(values: np.ndarray) -> np.ndarray:
    up, _ = POWERS.of(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def spans_hash(pref: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of [start, end), the same wherever the tokens stand."""
    _, down = POWERS.of(len(pref))
    return (pref[end] - pref[start]) * down[start]


def word_table(data: bytes):
    """Starts and ends of the maximal runs of other bytes than ASCII white space."""
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    return edge[0::2], edge[1::2]


def tokens_of(texts: list[bytes], spec: Spec):
    """Token values of a chunk of texts and the number of tokens of each."""
    if spec.tokens == "bytes":
        return BYTE_VALUES[np.frombuffer(b"".join(texts), np.uint8)], np.array([len(t) for t in texts], np.int64)
    data = b" ".join(texts) + b" "
    start, end = word_table(data)
    values = mix(spans_hash(prefix(BYTE_VALUES[np.frombuffer(data, np.uint8)]), start, end) + (end - start).astype(np.uint64))
    limits = np.cumsum([len(t) + 1 for t in texts])
    at = np.searchsorted(start, limits)
    return values, np.diff(np.concatenate(([0], at)))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by prefix and suffix minima of blocks."""
    n = len(x)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def runs_of(values: np.ndarray, lengths: np.ndarray, spec: Spec):
    """Runs of windows with one minimiser: (document, first window, windows, place of the minimiser, fingerprints)."""
    W, K, n = spec.window, spec.gram, len(values)
    if n < W:
        return None
    ends = np.cumsum(lengths)
    owner_end = np.repeat(ends, lengths)
    pref = prefix(values)
    at = np.arange(n - K + 1)
    grams = mix(spans_hash(pref, at, at + K))
    mask = np.uint64((1 << POSITION_BITS) - 1)
    keys = (grams & ~mask) | at.astype(np.uint64)
    anchor = (sliding_min(keys, W - K + 1) & mask).astype(np.int64)
    first = np.arange(n - W + 1)
    valid = first + W <= owner_end[: n - W + 1]
    fresh = valid.copy()
    fresh[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    start = np.flatnonzero(fresh)
    if not len(start):
        return None
    stop = valid.copy()
    stop[:-1] &= fresh[1:] | ~valid[1:]
    last = np.flatnonzero(stop)
    anchor = anchor[start]
    doc = np.searchsorted(ends, start, side="right")
    base = ends[doc] - lengths[doc]
    shape = (anchor - start).astype(np.uint64) * np.uint64(0x100000001B3) + (last - start).astype(np.uint64) * np.uint64(0x1000193)
    seg = mix(spans_hash(pref, start, last + W) + mix(shape))
    return doc, start - base, last - start + 1, anchor - start, grams[anchor].view(np.int64), seg.view(np.int64)


def pieces(text: bytes, spec: Spec, limit: int = 4 * CHUNK_BYTES):
    """A very long text in parts that overlap by all but one token of a window: (part, its first token)."""
    if len(text) <= limit:
        yield text, 0
        return
    size = limit if spec.tokens == "bytes" else max(spec.window, limit // 8)
    start, end = word_table(text) if spec.tokens == "words" else (None, None)
    n = len(text) if start is None else len(start)
    for base in range(0, max(1, n - spec.window + 1), size):
        top = min(n, base + size + spec.window - 1)
        if top > base:
            yield (text[base:top] if start is None else text[start[base] : end[top - 1]]), base


def emit_runs(docs: DataFrame, spec: Spec) -> DataFrame:
    schema = "fp long, seg long, key long, doc long, place long"

    def run(batches):
        for batch in batches:
            texts = binaries(batch.column("text"))
            names = zip(batch.column("key").to_pylist(), batch.column("doc").to_pylist(), strict=True)
            items = ((name, part, base) for name, t in zip(names, texts, strict=True) if t for part, base in pieces(t, spec))
            for chunk in chunked(items, lambda x: len(x[1])):
                found = runs_of(*tokens_of([t for _, t, _ in chunk], spec), spec)
                if found is None:
                    continue
                doc, start, count, offset, fp, seg = found
                own, base = np.array([x[0] for x in chunk], np.int64)[doc], np.array([x[2] for x in chunk], np.int64)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp), pa.array(seg), pa.array(own[:, 0]), pa.array(own[:, 1]), pa.array(((start + base) << 24) | (count << 12) | offset)],
                    ["fp", "seg", "key", "doc", "place"],
                )

    return docs.select("key", "doc", "text").mapInArrow(run, schema)


def start_of(place="place"):
    return F.shiftrightunsigned(place, 24)


def count_of(place="place"):
    return F.shiftrightunsigned(place, 12).bitwiseAND(F.lit(4095))


def spread(places: DataFrame, spec: Spec) -> DataFrame:
    """Token intervals of runs whose windows all repeat."""
    return places.select("key", "doc", start_of().alias("lo"), (start_of() + count_of() + F.lit(spec.window - 1)).alias("hi"))


def run_strings(docs: DataFrame, candidates: DataFrame, spec: Spec) -> DataFrame:
    """The string of each run in `candidates` (fp, seg, key, doc, place), as column body; words joined by one space."""
    by_doc = candidates.groupBy("key", "doc").agg(F.collect_set(F.struct("fp", "seg", "place")).alias("runs"))
    joined = packed_text(docs, "key", "doc").join(by_doc, ["key", "doc"])

    def run(batches):
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in batches:
            runs = batch.column("runs")
            for row, blob in enumerate(batch.column("packed").to_pylist()):
                text, key, doc = press.decompress(blob), batch.column("key")[row].as_py(), batch.column("doc")[row].as_py()
                own = runs[row].values
                fp, seg, place = (own.field(c).to_numpy() for c in ("fp", "seg", "place"))
                first, last = place >> 24, (place >> 24) + ((place >> 12) & 4095) + spec.window - 2
                if spec.tokens == "words":
                    text = b" ".join(text.split())
                    start, end = word_table(text)
                    first, last = start[first], end[last]
                else:
                    last = last + 1
                for at in range(0, len(place), 8192):
                    part = slice(at, at + 8192)
                    body = [text[a:b] for a, b in zip(first[part].tolist(), last[part].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(fp[part]), pa.array(seg[part]), pa.array(np.full(len(body), key, np.int64)), pa.array(np.full(len(body), doc, np.int64)), pa.array(place[part]), pa.array(body, pa.binary())], ["fp", "seg", "key", "doc", "place", "body"])

    return joined.mapInArrow(run, "fp long, seg long, key long, doc long, place long, body binary")


def string_classes(strings: DataFrame) -> DataFrame:
    """Distinct strings of runs: fp, seg, shape (windows and minimiser's place), body, n, and key, doc and place where n = 1."""
    shaped = strings.withColumn("shape", F.col("place").bitwiseAND(F.lit((1 << 24) - 1)))
    return shaped.groupBy("fp", "seg", "shape", "body").agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min("doc").alias("doc"), F.min("place").alias("place"))


def found_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(len(names))], names)


def exact_windows(classes: DataFrame, spec: Spec) -> DataFrame:
    """FOUND of the repeated windows in `classes`, window by window, for groups of any size.

    Fingerprints only keep back windows that can't repeat; the others are grouped as strings.
    """
    own = ["fp", "seg", "n", "key", "doc", "place"]
    rows = classes.select(*own, "body", F.xxhash64("fp", "seg", "shape", "body").alias("cid"))

    def prints(batches):
        for batch in batches:
            for cid, place, n, body in zip(*(batch.column(c).to_pylist() for c in ("cid", "place", "n", "body")), strict=True):
                at = np.arange((place >> 12) & 4095)
                values, _ = tokens_of([body], spec)
                found = mix(spans_hash(prefix(values), at, at + spec.window)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(at), cid, np.int64)), pa.array(at), pa.array(np.full(len(at), n, np.int64))], ["h", "cid", "j", "n"])

    def strings(batches):
        for batch in batches:
            for *named, body, chosen in zip(*(batch.column(c).to_pylist() for c in (*own, "body", "js")), strict=True):
                chosen = sorted(j for j in chosen if j < ((named[-1] >> 12) & 4095))
                start, end = word_table(body) if spec.tokens == "words" else (range(len(body)), range(1, len(body) + 1))
                cut = [body[start[j] : end[j + spec.window - 1]] for j in chosen]
                for at in range(0, len(cut), 4096):
                    part = cut[at : at + 4096]
                    first = np.array(chosen[at : at + 4096], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), *(pa.array(np.full(len(part), x, np.int64)) for x in named), pa.array(first)], ["w", *own, "lo"])

    printed = materialize(rows.select("cid", "place", "n", "body").mapInArrow(prints, "h long, cid long, j long, n long"), "window-prints")
    many = materialize(printed.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "window-many")
    alive = printed.join(many, "h", "left_semi").groupBy("cid").agg(F.collect_set("j").alias("js"))
    windows = materialize(rows.join(alive, "cid").select(*own, "body", "js").mapInArrow(strings, "w binary, " + FOUND.rsplit(", ", 1)[0]), "windows")
    twice = materialize(windows.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w"), "windows-twice")
    flagged = windows.join(twice, "w", "left_semi").select(*own, "lo", (F.col("lo") + spec.window).alias("hi"))
    # of a string with copies every window is counted more than once, so they make one interval
    copied = flagged.where("n > 1").groupBy(*own).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    found = materialize(flagged.where("n = 1").unionByName(copied), "window-spans")
    scrap(printed, many, windows, twice)
    return found


def intervals_from(flags: np.ndarray, start: int, window: int):
    """Token intervals covered by the flagged windows of a run that begins at token `start`."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(start + int(a), start + int(b) - 1 + window) for a, b in zip(edge[0::2], edge[1::2], strict=True)]


def members(candidates: DataFrame, docs: DataFrame, classes: DataFrame, found: DataFrame, spec: Spec) -> tuple[DataFrame, list[DataFrame]]:
    """(key, doc, lo, hi) of what was found in strings with copies, for each of the copies in `candidates`, and tables it reads.

    (fp, seg) names a class wherever only one class has that name, which is known from the strings;
    should two ever share it, their members are told apart by their strings.  Classes that hold over
    a `HEAVY`th of all rows are at most HEAVY kinds, with one interval each: these are broadcast, and
    their rows stay where they are; the rest is joined by shuffle.
    """
    on = ["fp", "seg"]
    total = classes.agg(F.sum("n")).first()[0] or 0
    twins = materialize(classes.groupBy(*on).agg(F.count("*").alias("kinds")).where("kinds > 1").select(*on), "twins")
    repeated = found.where("n > 1").select(*on, "n", "lo", "hi").distinct()
    some = bool(twins.take(1))
    if some:
        repeated = repeated.join(twins, on, "left_anti")
    # written, so that the join by shuffle can split a hot name
    repeated = materialize(repeated, "repeated")
    heavy = F.broadcast(repeated.where(F.col("n") * HEAVY > total).drop("n"))
    light = repeated.where(F.col("n") * HEAVY <= total).drop("n")
    joined = candidates.join(heavy, on).unionByName(candidates.join(heavy, on, "left_anti").join(light, on))
    out = joined.select("key", "doc", (start_of() + F.col("lo")).alias("lo"), (start_of() + F.col("hi")).alias("hi"))
    if some:
        named = [*on, "shape", "body"]
        told = run_strings(docs, candidates.join(twins, on, "left_semi"), spec).withColumn("shape", F.col("place").bitwiseAND(F.lit((1 << 24) - 1)))
        out = out.unionByName(spread(told.join(classes.where("n > 1").select(*named), named, "left_semi"), spec))
    return out, [twins, repeated]


def repeated_intervals(docs: DataFrame, spec: Spec, compared) -> DataFrame:
    """(key, doc, lo, hi): token intervals covered by windows that also start elsewhere.

    docs: key, doc (long), text.  compared(classes, spec) takes the distinct strings with their
    numbers and returns a written table of FOUND: the repeated windows of each.
    """
    runs = materialize(emit_runs(docs, spec), "runs")
    # written first: only a side that is no aggregate of the join's own stage lets a hot minimiser be split
    known = materialize(runs.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "minimisers")
    candidates = materialize(runs.join(known, "fp", "left_semi"), "candidates")
    scrap(runs, known)
    classes = materialize(string_classes(run_strings(docs, candidates, spec)), "classes")
    found = compared(classes, spec)
    alone = found.where("n = 1").select("key", "doc", (start_of() + F.col("lo")).alias("lo"), (start_of() + F.col("hi")).alias("hi"))
    copied, used = members(candidates, docs, classes, found, spec)
    out = materialize(alone.unionByName(copied), "spans")
    scrap(candidates, classes, found, *used)
    return out


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def with_intervals(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, packed text and the list of its intervals."""
    by_doc = spans.groupBy("key", "doc").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return packed_text(docs, "key", "doc", "doc_id").join(by_doc, ["key", "doc"], "left").drop("key", "doc")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key("doc_id", "text").alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
