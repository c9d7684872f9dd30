"""Fill-in-middle transformation, cut by a wavelet matrix over character classes.

The bytes of a chunk of texts become classes (continuation, letter, digit, blank, newline, mark, wide),
stored in a wavelet matrix: three bit vectors with ranks.  The boundaries of a unit are the places of some
classes (code points begin at every class but continuations; words and lines end in blanks and
newlines), so the ranks of these classes add up to boundary counts, and bisection on the counts finds
the byte at which a given number of units ends.  All cuts of a chunk are bisected together.

Cuts and forms follow from a hash of the doc_id, so they need no state and survive lost executors.  A row is
worked on where it is read; nothing is shuffled.

Defined cases: a null text is empty, and empty texts stay plain; a text that holds a sentinel stays
plain, so every output can be taken apart again; a null doc_id hashes as an empty one; repeated rows give
equal results; very long texts are chunks of their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import binaries, chunked, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Percent of texts that are transformed, and of these, percent whose suffix comes first.
RATE, SUFFIX_FIRST = 90, 20

CONTINUATION, LETTER, DIGIT, BLANK, NEWLINE, MARK, WIDE = range(7)
BITS = 3


def class_of(byte: int) -> int:
    if byte >= 128:
        return CONTINUATION if byte < 192 else WIDE
    one = chr(byte)
    return NEWLINE if one == "\n" else BLANK if one in "\t\v\f\r " else DIGIT if one.isdigit() else LETTER if one.isalpha() else MARK


CLASSES = np.array([class_of(b) for b in range(256)], np.uint8)
#: For each kind of unit the classes at its boundaries, and whether these begin a unit (else they end one).
UNITS = {"code_points": ((LETTER, DIGIT, BLANK, NEWLINE, MARK, WIDE), True), "words": ((BLANK, NEWLINE), False), "lines": ((NEWLINE,), False)}


class Ranks:
    """A bit vector with the set bits before each word of 64, so that a rank is one lookup and one count."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(-(-len(bits) // 64) * 8 + 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        words[: len(packed)] = packed
        self.words = words.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    """Ranks of every class over a sequence of classes: one bit vector per bit, zeros moved before ones at each."""

    def __init__(self, classes: np.ndarray, bits: int = BITS):
        self.levels = []
        for shift in reversed(range(bits)):
            bit = (classes >> shift) & 1
            zeros = classes[bit == 0]
            self.levels.append((shift, Ranks(bit), len(zeros)))
            classes = np.concatenate((zeros, classes[bit == 1]))

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How many places before each of `at` hold the class."""
        low, high = np.zeros_like(at), at
        for shift, ranks, zeros in self.levels:
            below, upto = ranks.ones(low), ranks.ones(high)
            low, high = (zeros + below, zeros + upto) if kind >> shift & 1 else (low - below, high - upto)
        return high - low

    def boundaries(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many places before each of `at` hold one of the classes."""
        rest = [k for k in range(1 << len(self.levels)) if k not in kinds]
        if len(rest) < len(kinds):
            return at - sum(self.rank(k, at) for k in rest)
        return sum(self.rank(k, at) for k in kinds)


def pieces(texts: list[bytes], shares, units: str = "code_points") -> list[tuple[int, int, int, int, int]]:
    """For each text its units, the units before the first and the second cut, and the bytes before them.

    shares(i, n) gives the units that text i of n units has before either cut, smaller one first.
    """
    kinds, begins = UNITS[units]
    data = np.frombuffer(b"".join(texts), np.uint8)
    matrix = WaveletMatrix(CLASSES[data])
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    start = end - size
    base = matrix.boundaries(kinds, start)
    total = matrix.boundaries(kinds, end) - base
    if not begins:
        # what follows the last end is a unit as well
        total += (size > 0) & ~np.isin(CLASSES[data[np.maximum(end - 1, 0)]] if len(data) else np.zeros(len(size)), kinds)
    wanted = np.array([shares(i, int(n)) for i, n in enumerate(total)], np.int64).reshape(-1, 2)
    low, high = np.repeat(start, 2), np.repeat(end, 2)
    goal = wanted.ravel() + np.repeat(base, 2)
    # beginnings: the last place with at most as many before it; ends: the first place with as many before it
    first = low.copy()
    while (low < high).any():
        mid = (low + high + begins) >> 1
        count = matrix.boundaries(kinds, mid)
        if begins:
            ok = count <= goal
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        else:
            ok = (count >= goal) | (low == high)
            low, high = np.where(ok, low, mid + 1), np.where(ok, mid, high)
    cut = (low - first).reshape(-1, 2)
    return [(int(n), int(a), int(b), int(x), int(y)) for n, (a, b), (x, y) in zip(total, wanted, cut, strict=True)]


def numbers(doc_id, seed: int = SEED) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(docs: DataFrame, units: str = "code_points", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_units, middle_units (null if plain), output."""
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches):
        for batch in batches:
            items = zip(batch.column("doc_id").to_pylist(), (t or b"" for t in binaries(batch.column("text"))), strict=True)
            for chunk in chunked(items, lambda x: len(x[1])):
                drawn = [numbers(doc_id, seed) for doc_id, _ in chunk]
                texts = [t for _, t in chunk]
                found = pieces(texts, lambda i, n, drawn=drawn: sorted(h % (n + 1) for h in drawn[i][:2]), units)
                rows = []
                for (doc_id, text), h, (n, a, b, x, y) in zip(chunk, drawn, found, strict=True):
                    if not text or h[2] % 100 >= rate or any(m in text for m in marks):
                        rows.append((doc_id, n, "plain", None, None, text))
                        continue
                    prefix, middle, suffix = text[:x], text[x:y], text[y:]
                    if h[3] % 100 < suffix_first:
                        form, out = "spm", (marks[1], suffix, marks[0], prefix, marks[2], middle)
                    else:
                        form, out = "psm", (marks[0], prefix, marks[1], suffix, marks[2], middle)
                    rows.append((doc_id, n, form, a, b - a, b"".join(out)))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*columns[:5], columns[5].cast(pa.string())], ["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_units long, middle_units long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from: no piece holds a sentinel, so each stands where it is first found."""
    text = F.col(output)
    opened, other, last = (F.instr(text, m) for m in (PREFIX, SUFFIX, MIDDLE))
    part = lambda lo, hi: F.substring(text, lo + 3, hi - lo - 3)
    middle = F.substring(text, last + 3, F.length(text))
    psm = F.concat(part(opened, other), middle, part(other, last))
    spm = F.concat(part(opened, last), middle, part(other, opened))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(text)


def query(spark, sf_dir):
    return transform(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


def oracle_sql() -> str:
    h = [f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT" for i in range(4)]
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
  cut AS (SELECT *, least({h[0]} % (n + 1), {h[1]} % (n + 1)) AS a, greatest({h[0]} % (n + 1), {h[1]} % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR {h[2]} % 100 >= {RATE} THEN 'plain' WHEN {h[3]} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM d),
  part AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM part"""
