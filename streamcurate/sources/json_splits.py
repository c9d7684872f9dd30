"""JSON files of one array, read in splits.

A file is read in pieces that end in a closing brace, so it splits wherever it has one, also if it is a
single line.  Whether a bracket or comma counts depends on the strings and brackets before it.  For each
block a first scan works out what the block does to both, for either assumption about strings; a window
over one row per block settles where each block begins.  A second scan cuts the items of the array; those
that run over the end of a block are put together by a shuffle.

A file is the items of its array, or else its one value.  A file that isn't valid JSON as a whole (an item that
can't be parsed, brackets or commas that don't fit, an open string) is one record, whose text can't be
parsed either.  Items of more than `MOST_CHARS` characters that run over a block's end come as null.
An empty file has no record.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.storage import discard, materialize
from .csv_splits import BROADCAST_ROWS, MOST_CHARS, by_blocks

SEPARATOR = "}"
ESCAPED = re.compile(r"\\.", re.S)
IN_STRING, OUTSIDE, SCALAR_END = re.compile(r'["\\]'), re.compile(r'["\[\]{}]'), re.compile(r"[,\]\s]")
SPACES = " \t\r\n"
ITEM = "file string, block long, place long, text string, part string, wrong boolean"


def scan(spark: SparkSession, paths) -> DataFrame:
    """file, block, size of the file, and the pieces without their closing brace."""
    return spark.read.option("lineSep", SEPARATOR).text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), "value")


def effect(text: str) -> tuple[bool, int, int]:
    """Whether a text turns inside into outside, and its brackets if it begins outside, and inside a string."""
    parts = ESCAPED.sub("", text).split('"') if "\\" in text else text.split('"')
    deltas = [sum(p.count("{") + p.count("[") - p.count("}") - p.count("]") for p in parts[k::2]) for k in (0, 1)]
    return len(parts) % 2 == 0, *deltas


def summaries(pieces: DataFrame) -> DataFrame:
    """One row per block: file, block, size (of the file), turns, d0, d1 (see `effect`), bytes, opens (its first character that isn't space)."""

    def run(batches):
        def row(key, x):
            return pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "size": x[5], "turns": x[0], "d0": x[1], "d1": x[2], "bytes": x[4], "opens": x[3]}], schema)

        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("turns", pa.bool_()), ("d0", pa.int64()), ("d1", pa.int64()), ("bytes", pa.int64()), ("opens", pa.string())])
        key, state = None, None
        for file, block, part in by_blocks(batches):
            if key != (file, block):
                if key:
                    yield row(key, state)
                key, state = (file, block), [False, 0, 0, None, 0, part.column("size")[0].as_py()]
            text = "".join(v + SEPARATOR for v in part.column("value").to_pylist())
            turns, a, b = effect(text)
            swapped = state[0]
            state[1] += b if swapped else a
            state[2] += a if swapped else b
            state[0] ^= turns
            state[3] = state[3] or text.lstrip(SPACES)[:1] or None
            state[4] += len(text.encode())
        if key:
            yield row(key, state)

    return pieces.mapInArrow(run, "file string, block long, size long, turns boolean, d0 long, d1 long, bytes long, opens string")


def entries(found: DataFrame) -> DataFrame:
    """file, block, inside, depth (as the block begins), array (whether the file is one), last (its last block, which ends without a brace)."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = found.withColumn("inside", F.coalesce(F.sum(F.col("turns").cast("long")).over(before), F.lit(0)) % 2 == 1)
    known = known.withColumn("delta", F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0")))
    return known.select("file", "block", "inside", F.coalesce(F.sum("delta").over(before), F.lit(0)).alias("depth"), (F.first("opens", ignorenulls=True).over(whole) == "[").alias("array"), (F.max("block").over(whole) == F.col("block")).alias("final"), ((F.max("block").over(whole) == F.col("block")) & (F.sum("bytes").over(whole) > F.col("size"))).alias("last"))


class Items:
    """Cuts the pieces of a block into items, as rows (text, part, wrong).

    part is null for whole items, `head` for what goes on from an earlier block and `tail` for what goes on
    after this one; wrong marks what can't stand between items.
    """

    def __init__(self, block: int, inside: bool, depth: int, array: bool):
        self.level, self.depth, self.inside = int(array), depth, inside
        # a block begins after a closing brace, so at the level itself an item has just ended
        self.due = None if block == 0 else "separator"
        self.opened = not array or block > 0
        self.held: list[str] | None = [] if block > 0 and (inside or depth > self.level) else None
        self.head = self.held is not None
        self.rows: list[tuple] = []

    def wrong(self, text: str) -> None:
        self.rows.append((f"not JSON: {text[:100]}", None, True))

    def end(self, text: str) -> None:
        self.rows.append(("".join([*self.held, text]), "head" if self.head else None, False))
        self.held, self.head, self.due = None, False, "separator"

    def take(self, text: str) -> None:
        at = start = 0
        size = len(text)
        while at < size:
            if self.held is None:
                c = text[at]
                if c in SPACES:
                    at += 1
                elif not self.opened:
                    self.opened, self.depth, at = True, 1, at + 1
                elif self.depth < self.level or (not self.level and self.due):
                    self.wrong(text[at:])
                    return
                elif c == "," and self.level:
                    if self.due != "separator":
                        self.wrong(text[at:])
                    self.due, at = "item", at + 1
                elif c == "]" and self.level:
                    if self.due == "item":
                        self.wrong(text[at:])
                    self.depth, at = self.depth - 1, at + 1
                else:
                    if self.due == "separator":
                        self.wrong(text[at:])
                    self.held, self.head, start = [], False, at
                    if c not in '"[{':
                        # a number or word ends before the next separator
                        found = SCALAR_END.search(text, at) if self.level else None
                        at = found.start() if found else size
                        self.end(text[start:at].rstrip(SPACES))
                continue
            found = (IN_STRING if self.inside else OUTSIDE).search(text, at)
            if not found:
                break
            at = found.end()
            c = found.group()
            if c == "\\":
                at += 1
            elif c == '"':
                self.inside = not self.inside
            else:
                self.depth += 1 if c in "[{" else -1
            if not self.inside and self.depth == self.level and c != "\\":
                self.end(text[start:at])
                start = at
        if self.held is not None:
            self.held.append(text[start:])

    def rest(self) -> None:
        if self.held:
            self.rows.append(("".join(self.held), "head" if self.head else "tail", False))
            self.held = None


def cut(pieces: DataFrame) -> DataFrame:
    """Rows of `ITEM`; place counts the rows of a block."""

    def run(batches):
        def rows(key, items, first):
            out = [(key[0], key[1], first + i, *r) for i, r in enumerate(items.rows)]
            items.rows = []
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names)

        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
        names = ["file", "block", "place", "text", "part", "wrong"]
        key, items, held, count = None, None, None, 0
        for file, block, part in by_blocks(batches):
            if key != (file, block):
                if key:
                    items.take(held if last else held + SEPARATOR)
                    items.rest()
                    yield rows(key, items, count)
                one = {c: part.column(c)[0].as_py() for c in ("inside", "depth", "array", "last")}
                key, items, held, count, last = (file, block), Items(block, one["inside"], one["depth"], bool(one["array"])), None, 0, one["last"]
            for text in part.column("value").to_pylist():
                if held is not None:
                    items.take(held + SEPARATOR)
                held = text
            out = rows(key, items, count)
            count += out.num_rows
            yield out
        if key:
            items.take(held if last else held + SEPARATOR)
            items.rest()
            yield rows(key, items, count)

    return pieces.select("file", "block", "value", "inside", "depth", "array", "last").mapInArrow(run, ITEM)


def split_json(spark: SparkSession, paths) -> DataFrame:
    """file, record_number (from 1), value: the items of each file's array, or its one value."""
    pieces = scan(spark, paths)
    found = materialize(summaries(pieces), "json-blocks")
    known = materialize(entries(found), "json-entries")
    if known.count() <= BROADCAST_ROWS:
        placed = pieces.join(F.broadcast(known), ["file", "block"])  # keeps the order of pieces
    else:
        placed = pieces.withColumn("order", F.monotonically_increasing_id()).join(known, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "order")
    items = materialize(cut(placed), "json-items")
    by_block = Window.partitionBy("file").orderBy("block")
    # an item belongs to the block that it begins in: a head to that of the last tail before it
    begun = items.groupBy("file", "block").agg(F.count(F.when(~F.col("wrong") & ~F.col("part").eqNullSafe("head"), 1)).alias("n"))
    bases = begun.select("file", "block", F.coalesce(F.sum("n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    bases = F.broadcast(bases) if known.count() <= BROADCAST_ROWS else bases
    head = F.col("part").eqNullSafe("head")
    # a head, if there is one, is the first row of its block
    offset = F.when(head, F.lit(0)).otherwise(F.col("place") + 1 - F.when(F.col("with_head"), 1).otherwise(0))
    heads = items.where(head).select("file", "block", F.lit(True).alias("_h"))
    heads = F.broadcast(heads) if known.count() <= BROADCAST_ROWS else heads
    ready = items.join(bases, ["file", "block"]).join(heads, ["file", "block"], "left").withColumn("with_head", F.coalesce("_h", F.lit(False)))
    ready = ready.select("file", "block", (F.col("base") + offset).alias("record_number"), "text", "part", "wrong")
    whole = ready.where("part IS NULL").select("file", "record_number", F.col("text").alias("value"), "wrong")
    parts = ready.where("part IS NOT NULL")
    sizes = parts.groupBy("file", "record_number").agg(F.sum(F.length("text")).alias("size"))
    joined = parts.join(sizes.where(F.col("size") <= MOST_CHARS), ["file", "record_number"], "left_semi").groupBy("file", "record_number").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    texts = joined.select("file", "record_number", F.array_join(F.col("parts.text"), "").alias("value"), F.lit(False).alias("wrong"))
    large = sizes.where(F.col("size") > MOST_CHARS).select("file", "record_number", F.lit(None).cast("string").alias("value"), F.lit(False).alias("wrong"))
    every = materialize(whole.unionByName(texts).unionByName(large), "json-records")
    # a file that isn't valid as a whole is one record
    # the brace after a file's last piece was counted, whether or not it is there
    missing = F.when(F.col("last"), 1).otherwise(0)
    ends = known.where("final").join(found, ["file", "block"]).select("file", (F.col("inside") != F.col("turns")).alias("open"), (F.col("depth") + F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0")) + missing).alias("depth"))
    one = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>")
    unparsed = F.col("wrong") | F.coalesce(F.size(one) != 1, F.lit(True))
    bad = every.where(unparsed & F.col("value").isNotNull()).groupBy("file").agg(F.min_by("value", "record_number").alias("value"))
    unclosed = ends.where("open OR depth > 0").select("file", F.lit("[").alias("_open"))
    bad = materialize(bad.join(unclosed, "file", "full").select("file", F.coalesce("value", "_open").alias("value")), "json-bad")
    discard(items)
    good = every.join(F.broadcast(bad.select("file")) if bad.count() <= BROADCAST_ROWS else bad.select("file"), "file", "left_anti")
    return good.select("file", "record_number", "value").unionByName(bad.select("file", F.lit(1).cast("long").alias("record_number"), "value"))
