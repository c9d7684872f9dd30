"""Token counts by a separator scan of flat, unindexed token files.

A flat file is little-endian 32-bit ids, documents one after another, each closed by an end id; no
index says where they begin.  Files are read in blocks of fixed size; each block is searched at once
for the end id, and leaves a summary: how many ends, ids before the first, ids after the last.  A
prefix scan over the summaries numbers the documents and carries the open part of each block into
the next, so a document that spans blocks, or the files of one writer, is stitched without moving
its ids.

Files that `write_tokens` makes carry each document's doc_id as its first `KEY_IDS` ids, numbers above
all token ids, so that counts come back with it; plain files have none (key_ids=0).  The scan leaves
these ids out of the counts.

Files are written by Spark's text sink: the last byte of an id under 2**24 is a zero byte, which
serves as the line separator, so any store Spark writes to will do.  A record is a piece of the
stream of about `RECORD_IDS` ids and a file takes `FILE_RECORDS` of them, so that neither grows with
a text.  Files are gzip streams, decompressed block by block.

Defined cases: a null or empty text is a document of no ids; a null doc_id comes back null; files
without a last end id have an open tail, counted as a document only if it has ids; repeated rows are
documents of their own; an empty table gives an empty result; other columns are ignored; the letters
of an added token inside a text are plain text, so that the end id stands between documents only.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunked, materialize, remove, shared_dir
from .packing import encoder, ids_of

#: Fixed value: the end-of-document id of the vocabulary.
END = 50256
#: Ids of a block.
BLOCK = 1 << 18
#: Ids of a record, about, and records of a file at most.
RECORD_IDS, FILE_RECORDS = 1 << 14, 1 << 10
#: A doc_id as ids above all tokens: three times 22 bits, the highest of them for null.
KEY_IDS, KEY_BITS, KEY_BASE = 3, 22, 1 << 24


def key_ids_of(doc_id: int | None) -> list[int]:
    value = 1 << 64 if doc_id is None else doc_id % (1 << 64)
    return [KEY_BASE + ((value >> (KEY_BITS * i)) & ((1 << KEY_BITS) - 1)) for i in range(KEY_IDS)]


def key_column(ids: Column) -> Column:
    """The doc_id of an array of key ids; null for one of another length."""
    part = lambda i: F.coalesce(F.get(ids, F.lit(i)), F.lit(0)).cast("long") - KEY_BASE
    high = part(2)
    value = part(0).bitwiseOR(F.shiftleft(part(1), KEY_BITS)).bitwiseOR(F.shiftleft(high.bitwiseAND(F.lit((1 << 20) - 1)), 2 * KEY_BITS))
    return F.when((F.size(ids) == KEY_IDS) & (F.shiftright(high, 20) == 0), value)


def write_tokens(docs: DataFrame, path: str, end: int = END, vocabulary: str | None = None) -> None:
    """Flat token files of all texts, each after its key ids; `end` has to be under 2**24."""

    def run(batches):
        # the end id is the vocabulary's added token, so a text that holds it as letters must not give it
        encode = encoder(vocabulary, added=False)
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_string()).to_pylist(), strict=True)
            for chunk in chunked(rows, lambda r: len(r[1] or "")):
                ids = np.concatenate([part for doc_id, t in chunk for part in (np.array(key_ids_of(doc_id), "<u4"), ids_of(encode, t), np.array([end], "<u4"))])
                # a record ends with an id of which the last byte is zero
                cuts = [at + int(np.argmax(ids[at : at + KEY_IDS + 1] < KEY_BASE)) + 1 for at in range(RECORD_IDS, len(ids) - KEY_IDS - 1, RECORD_IDS)]
                data = ids.tobytes()
                records = [data[4 * a : 4 * b - 1] for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["ids"])

    flat = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "ids binary")
    out = flat.select(F.col("ids").cast("string").alias("ids"))
    out.write.option("lineSep", "\x00").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def block_ends(ids: np.ndarray, end: int) -> np.ndarray:
    return np.flatnonzero(ids == end)


def blocks(content: bytes, block: int):
    """A file's ids in blocks, decompressed as they are needed."""
    size = block * 4
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), size):
            yield np.frombuffer(content[at : at + size], "<u4", count=min(size, len(content) - at) // 4)
        return
    press = zlib.decompressobj(31)
    held, fed = b"", content
    while fed or held:
        if fed:
            held += press.decompress(fed, size - len(held) + 1)
            fed = press.unconsumed_tail
        if len(held) >= size or not fed:
            yield np.frombuffer(held[:size], "<u4", count=min(size, len(held)) // 4)
            held = held[size:]
            if not fed and len(held) < 4:
                return


def scan(spark, path: str, end: int = END, block: int = BLOCK, key_ids: int = 0) -> DataFrame:
    """One row per block: file, block_no, ends, inner (lengths between ends), keys (of these), head and tail (ids before the first and after the last end; all are head in a block without), head_key, tail_key (their first ids)."""

    def run(batches):
        names = ["file", "block_no", "ends", "inner", "keys", "head", "tail", "head_key", "tail_key"]
        many = pa.list_(pa.int64())
        kinds = [pa.string(), pa.int64(), pa.int64(), many, pa.list_(many), pa.int64(), pa.int64(), many, many]
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                for no, ids in enumerate(blocks(content, block)):
                    at = block_ends(ids, end)
                    head, tail = (int(at[0]), len(ids) - int(at[-1]) - 1) if len(at) else (len(ids), 0)
                    starts = at[:-1] + 1
                    keys = [ids[a : min(a + key_ids, b)].tolist() for a, b in zip(starts.tolist(), at[1:].tolist(), strict=True)] if key_ids else [[]] * len(starts)
                    row = (file, no, len(at), (np.diff(at) - 1).tolist(), keys, head, tail, ids[: min(head, key_ids)].tolist(), ids[len(ids) - tail :][:key_ids].tolist())
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, block_no long, ends long, inner array<long>, keys array<array<long>>, head long, tail long, head_key array<long>, tail_key array<long>")


def document_lengths(spark, path: str, end: int = END, block: int = BLOCK, key_ids: int = 0) -> DataFrame:
    """file, doc_no (from 0 within a writer's files), key (its first key_ids ids), n_tokens (the others) of every document in flat token files.

    Files of one name but for a number at its end, as one writer leaves them, are one stream in order;
    `file` is the name without it.  block has to be key_ids at least.
    """
    summary = materialize(scan(spark, path, end, max(block, key_ids), key_ids), "token-blocks")
    summary = summary.withColumn("stream", F.regexp_replace(F.regexp_extract("file", r"[^/]+$", 0), r"-c\d+\.[^/]*$", ""))
    order = Window.partitionBy("stream").orderBy("file", "block_no")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    # ids carried into a block: what blocks left open since the last one that held an end
    heads = F.sum(F.when(F.col("ends") == 0, F.col("head")).otherwise(0)).over(past)
    marked = summary.withColumn("before", F.coalesce(F.sum("ends").over(past), F.lit(0))).withColumn("ran", F.coalesce(heads, F.lit(0))).withColumn("number", F.row_number().over(order))
    # total open ids up to here minus the total when the last end was seen, plus that block's tail
    at_end = F.last(F.when(F.col("ends") > 0, F.col("tail") - F.col("ran")), ignorenulls=True).over(past)
    # the open document's key begins behind the last end, or with the stream, and ends in the next block at the latest
    none = F.expr("cast(array() as array<long>)")
    joined = F.slice(F.concat("tail_key", F.coalesce(F.lead("head_key").over(order), none)), F.lit(1), F.lit(max(1, key_ids)))
    first = F.slice(F.concat("head_key", F.when(F.col("ends") == 0, F.coalesce(F.lead("head_key").over(order), none)).otherwise(none)), F.lit(1), F.lit(max(1, key_ids)))
    opened = F.when(F.col("ends") > 0, joined).when(F.col("number") == 1, first)
    whole = marked.withColumn("opened", opened).withColumn("carry", F.col("ran") + F.coalesce(at_end, F.lit(0)))
    carried = whole.withColumn("key", F.coalesce(F.last("opened", ignorenulls=True).over(past), first))
    pair = F.struct((F.col("carry") + F.col("head")).alias("n"), F.col("key").alias("key"))
    inner = F.zip_with("inner", "keys", lambda n, k: F.struct(n.alias("n"), k.alias("key")))
    closed = carried.where("ends > 0").select("stream", "before", F.concat(F.array(pair), inner).alias("found"))
    each = closed.select("stream", "before", F.posexplode("found").alias("i", "x")).select(F.col("stream").alias("file"), (F.col("before") + F.col("i")).alias("doc_no"), "x.key", (F.col("x.n") - F.size("x.key")).alias("n_tokens"))
    last = F.struct(
        (F.col("before") + F.col("ends")).alias("doc_no"),
        F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("head")).alias("n"),
        F.when(F.col("ends") > 0, F.col("tail_key")).otherwise(F.col("key")).alias("key"),
    )
    final = carried.groupBy("stream").agg(F.max_by(last, "number").alias("x")).where("x.n > 0")
    return each.unionByName(final.select(F.col("stream").alias("file"), "x.doc_no", "x.key", (F.col("x.n") - F.size("x.key")).alias("n_tokens")))


def token_counts(docs: DataFrame, end: int = END, block: int = BLOCK, vocabulary: str | None = None) -> DataFrame:
    """Number of tokens of each document, from flat files written of all texts: doc_id, n_tokens."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, end, vocabulary)
    lengths = document_lengths(spark, path, end, block, KEY_IDS).select(key_column(F.col("key")).alias("doc_id"), "n_tokens")
    remove(spark, path)  # summaries of its blocks are written by now
    return lengths


def query(spark, sf_dir):
    from .common import table

    return token_counts(table(spark, sf_dir, "documents"))
