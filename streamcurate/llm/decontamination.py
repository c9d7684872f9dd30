"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items are normalised to words and built into one automaton.  Its states hold the items whose windows
end there.  Training words stream through it; the state reached and its suffix links give the longest
match that ends at each word, and with it the windows of items that end there.  Stretches whose
neighbouring word pairs don't all occur in the items can't hold a window and are skipped by a
vectorised test, so the automaton walks only near possible hits.

Automata are built in tasks, from blocks of about `block_words` words; an item longer than that is
cut into parts that overlap by all but one word of a window.  Each automaton so has a bound and is
broadcast on its own.  Texts are read and split once, whatever the number of blocks; a worker holds
as many automata as `HELD_BYTES` allow and loads the others as it needs them.

Defined cases: null texts and texts without words have no hits; items without words have no
windows; an item without an id hits words and counts in n_items, but has no name to list; items of equal text count each; repeated rows are judged each; an empty benchmark or table
gives no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, chunked, materialize, scrap, table, whole_row

WINDOW = 13
#: A document is contaminated if hit words are at least one part in so many.
SHARE = 20
BLOCK_WORDS = 250_000
#: Bytes of pickled automata that a worker keeps loaded.
HELD_BYTES = 64 << 20
#: Words: ASCII digits and letters, lower-cased, and everything beyond ASCII; the rest separates.
FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences; `owners` has the items of each (state, window size)."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.owners: dict[tuple[int, int], list[str]] = {}
        sizes, pairs, known = set(), set(), []
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if not ids:
                continue
            last = 0
            for i in ids:
                last = self.extend(last, i)
            known.append((name, ids, min(window, len(ids))))
            sizes.add(min(window, len(ids)))
            pairs.update(zip(ids, ids[1:], strict=False))
        self.sizes = sorted(sizes)
        self.pairs = np.array(sorted(a * len(self.vocabulary) + b for a, b in pairs), np.int64)
        for name, ids, size in known:
            state = 0
            for at, i in enumerate(ids):
                state = self.holding(self.next[state][i], min(size, at + 1))
                if at + 1 >= size:
                    names = self.owners.setdefault((state, size), [])
                    if not names or names[-1] != name:
                        names.append(name)

    def holding(self, state: int, size: int) -> int:
        """The state of the last `size` words of what `state` stands for."""
        while self.length[state] and self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def extend(self, last: int, symbol: int) -> int:
        """Adds a word after state `last`; shared prefixes of other items are walked, not rebuilt."""
        known = self.next[last].get(symbol)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is None:
            made = self.state(self.length[last] + 1, {})
        p = last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = made
            p = self.link[p]
        if p < 0:
            self.link[made] = 0
            return made
        q = self.next[p][symbol]
        if self.length[q] == self.length[p] + 1:
            if known is None:
                self.link[made] = q
                return made
            return q
        copy = self.state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        self.link[q] = copy
        if known is not None:
            return copy
        self.link[made] = copy
        return made

    def state(self, length: int, arrows: dict[int, int]) -> int:
        self.next.append(arrows)
        self.link.append(-1)
        self.length.append(length)
        return len(self.length) - 1

    def hits(self, ids: list[int], offset: int = 0):
        """(first, end, items) of every window of an item that occurs in `ids`."""
        state = matched = 0
        most = self.sizes[-1]
        for at, i in enumerate(ids):
            while state and i not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if i in self.next[state]:
                state = self.next[state][i]
                matched += 1
            if matched > most:
                state, matched = self.holding(state, most), most
            for size in self.sizes:
                if size > matched:
                    break
                owners = self.owners.get((self.holding(state, size), size))
                if owners:
                    yield offset + at + 1 - size, offset + at + 1, owners

    def stretches(self, ids: np.ndarray):
        """(lo, hi) stretches of words that may hold a window: every neighbouring pair occurs in the items."""
        if not self.sizes:
            return
        need = self.sizes[0]
        if need == 1:
            good = ids >= 0
        else:
            key = ids[:-1] * len(self.vocabulary) + ids[1:]
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            good = (ids[:-1] >= 0) & (ids[1:] >= 0) & ((self.pairs[at] == key) if len(self.pairs) else False)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], good.astype(np.int8), [0]))))
        lo, hi = edge[0::2], edge[1::2]
        if need > 1:
            hi = hi + 1
        for k in np.flatnonzero(hi - lo >= need):
            yield int(lo[k]), int(hi[k])


def automata(benchmark: DataFrame, window: int, block_words: int) -> list:
    """Broadcasts of pickled automata, one for each block of items; built in tasks."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")

    def cut(batches):
        for batch in batches:
            for name, text in zip(batch.column("item_id").to_pylist(), binaries(batch.column("text")), strict=True):
                words = words_of(text)
                step = max(1, block_words)
                for at in range(0, max(1, len(words) - window + 1), step):
                    part = words[at : at + step + window - 1]
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([len(part)], pa.int64()), pa.array([b" ".join(part)], pa.binary())], ["item_id", "n", "words"])

    parts = materialize(items.mapInArrow(cut, "item_id string, n long, words binary").where("n > 0"), "item-parts")
    count = max(1, -(-(parts.agg(F.sum("n")).first()[0] or 0) // block_words))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        items = [(None if pd.isna(name) else name, words) for name, words in zip(rows["item_id"], rows["words"], strict=True)]
        machine = Automaton(sorted(items, key=lambda x: (x[0] is None, x[0] or "", x[1])), window)
        return pd.DataFrame({"block": rows["block"][:1], "blob": [pickle.dumps(vars(machine))]})

    dealt = parts.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(count)).cast("int"))
    built = materialize(dealt.groupBy("block").applyInPandas(build, "block int, blob binary"), "automata")
    sent = [spark.sparkContext.broadcast(bytes(built.where(F.col("block") == r.block).first().blob)) for r in built.select("block").orderBy("block").collect()]
    scrap(parts, built)
    return sent


def scan(docs: DataFrame, blobs: list, ids: tuple[str, ...]) -> DataFrame:
    """`ids`, n_words, spans array<struct<lo, hi>> (words, merged), items array<string>."""
    schema = docs.select(*ids, F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<lo:long,hi:long>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items")).schema
    kinds = [pa.int64(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.list_(pa.string())]

    def run(batches):
        held: dict[int, Automaton] = {}
        free = HELD_BYTES

        def machine(k: int) -> Automaton:
            nonlocal free
            if k in held:
                return held[k]
            blob = blobs[k].value
            found = Automaton([], 1)
            vars(found).update(pickle.loads(blob))
            if len(blob) <= free:
                held[k] = found
                free -= len(blob)
            return found

        for batch in batches:
            counts, spans, items = [], [], []
            for chunk in chunked(binaries(batch.column("text")), lambda t: len(t or b"")):
                split = [words_of(t) for t in chunk]
                sizes = [len(w) for w in split]
                ends = np.cumsum(np.array(sizes, np.int64) + 1)
                hits: dict[int, list] = {}
                for k in range(len(blobs)):
                    one = machine(k)
                    get = one.vocabulary.get
                    # a separator after each document keeps pairs inside it
                    flat = np.fromiter((get(w, -1) for words in split for w in (*words, b" ")), np.int64, sum(sizes) + len(sizes))
                    for lo, hi in one.stretches(flat):
                        doc = int(np.searchsorted(ends, lo, side="right"))
                        base = int(ends[doc]) - sizes[doc] - 1
                        hits.setdefault(doc, []).extend(one.hits(flat[lo:hi].tolist(), lo - base))
                for doc, n in enumerate(sizes):
                    counts.append(n)
                    own, names = [], set()
                    for lo, hi, owners in sorted(hits.get(doc, ()), key=lambda h: h[:2]):
                        names.update(owners)
                        if own and lo <= own[-1]["hi"]:
                            own[-1]["hi"] = max(own[-1]["hi"], hi)
                        else:
                            own.append({"lo": lo, "hi": hi})
                    spans.append(own)
                    items.append(sorted(names, key=lambda x: (x is None, x or "")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ids), *(pa.array(v, k) for v, k in zip((counts, spans, items), kinds, strict=True))], [*ids, "n_words", "spans", "items"])

    return docs.select(*ids, "text").mapInArrow(run, schema)


def hits(docs: DataFrame, benchmark: DataFrame, ids: tuple[str, ...], window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`ids`, n_words, n_hit, spans, items of each row."""
    out = scan(docs.withColumn("text", F.col("text").cast("string")), automata(benchmark, window, block_words), ids)
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return out.select(*ids, "n_words", covered.alias("n_hit"), "spans", "items")


def contaminated(n_hit="n_hit", n_words="n_words", share: int = SHARE):
    return (F.col(n_hit) > 0) & (F.col(n_hit) * share >= F.col(n_words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (hit words)."""
    found = hits(docs, benchmark, ("doc_id",), window, block_words)
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(share=share).alias("contaminated"),
        "spans",
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` that aren't contaminated, as they are."""
    # inside a struct the columns can't clash with those of the results
    rows = docs.select(whole_row(docs).alias("_all"), "text")
    return hits(rows, benchmark, ("_all",), window, block_words).where(~contaminated(share=share)).select("_all.*")


def query(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def oracle_sql() -> str:
    """DuckDB: windows of documents and items meet as joined words."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all({lower.format("text")}, '{pattern}'), []) AS w FROM documents),
  b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({lower.format("text")}, '{pattern}') AS w FROM benchmark WHERE text IS NOT NULL),
  iw AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS size, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least({WINDOW}, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
  sizes AS (SELECT DISTINCT size FROM iw),
  dw AS (SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM (SELECT rid, size, w, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes)),
  hit AS (SELECT rid, i, dw.size, item_id FROM dw JOIN iw USING (size, s)),
  marked AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY rid),
  named AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN marked USING (rid) LEFT JOIN named USING (rid)"""
