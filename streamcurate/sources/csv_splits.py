"""CSV with quoted newlines, read in splits.

Whether a newline ends a record depends on the quotes before it.  A line maps the state it begins in
(outside or inside quotes) to the one it ends in; such maps compose, so a task works out, for the lines
of its block, both what holds if the block begins outside quotes and what holds if it begins inside.
One row per block then settles, by a window over the blocks of a file, which of the two is true and
how many records came before.  A second scan cuts the records; only those that run over the end of a
block are put together by a shuffle.  So no file is read as a whole, and nothing is sorted.

Quotes follow the usual rules: they count at the start of a cell only; a doubled one inside is one quote; what
follows a closing one is taken as it is; backslashes are plain characters.  Lines end in \\n, \\r\\n or \\r.
Blank lines aren't records.  The first record of each file is its header.

Defined cases: an unclosed quote runs to the end of the file; a record of several lines and
more than `MOST_CHARS` characters comes without cells (null); an empty file has no header and no records; a byte order mark is skipped.
"""

from __future__ import annotations

import csv
import io
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.storage import materialize

#: Characters of a record that runs over several lines.
MOST_CHARS = 64 << 20
#: Up to so many blocks or files are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 100_000


@dataclass
class CsvFiles:
    """records: file, record_number (from 1), cells array<string>; headers: file, header array<string>."""

    records: DataFrame
    headers: DataFrame


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the line's end is inside quotes."""
    at = 0
    if not inside:
        if not line.startswith('"'):
            at = line.find(',"') + 1
            if not at:
                return False
        at += 1
    while True:
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('"', at + 1):
            at += 2
            continue
        at = line.find(',"', at + 1)
        if at < 0:
            return False
        at += 2


def split_returns(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lines cut after each \\r that isn't their last character, and which of the parts end in such a one."""
    if not pc.any(pc.match_substring_regex(values, "\r.")).as_py():
        return values, np.zeros(len(values), bool)
    parts, lone = [], []
    for text in values.to_pylist():
        own = list(io.StringIO(text, newline="")) or [""]
        parts += own
        lone += [True] * (len(own) - 1) + [False]
    return pa.array(parts, pa.string()), np.array(lone, bool)


def blanks(values: pa.Array) -> np.ndarray:
    length = pc.binary_length(values).to_numpy()
    return (length == 0) | ((length == 1) & np.asarray(pc.equal(values, "\r").to_numpy(zero_copy_only=False), bool))


def quotes(values: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring(values, '"').to_numpy(zero_copy_only=False), bool)


class Summary:
    """What the lines of a block come to, if it begins outside (0) and if it begins inside quotes (1)."""

    def __init__(self, block: int):
        self.first, self.state, self.count = block == 0, [False, True], [0, 0]
        #: A file's first line where it is its header for sure, having no quotes.
        self.header: str | None = None

    def take(self, values: pa.Array) -> None:
        values, _ = split_returns(values)
        blank, quoted = blanks(values), quotes(values)
        if self.first:
            blank[0], self.first = False, False  # a header, even if it is blank
            self.header = None if quoted[0] else values[0].as_py().removesuffix("\r")
        at_quotes = [(i, values[i].as_py()) for i in np.flatnonzero(quoted).tolist()]
        full = np.concatenate(([0], np.cumsum(~blank)))
        for k in (0, 1):
            state, count, at = self.state[k], self.count[k], 0
            for i, line in at_quotes:
                # lines without quotes keep the state; records begin outside
                if not state:
                    count += int(full[i + 1] - full[at])
                state, at = ends_inside(line, state), i + 1
            if not state:
                count += int(full[-1] - full[at])
            self.state[k], self.count[k] = state, count


def scan(spark: SparkSession, paths) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def by_blocks(batches):
    """(file, block, batch) of lines of one block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file"), batch.column("block").to_numpy()
        cut = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(pc.dictionary_encode(files).indices.to_numpy()) != 0)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(blocks)], strict=True):
            yield files[lo].as_py(), int(blocks[lo]), batch.slice(lo, hi - lo)


def summaries(lines: DataFrame) -> DataFrame:
    """One row per block: file, block, out0, out1 (whether it ends inside quotes), n0, n1 (records that begin in it), header."""

    def run(batches):
        def row(key, x):
            return pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "out0": x.state[0], "out1": x.state[1], "n0": x.count[0], "n1": x.count[1], "header": x.header}], schema)

        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("out0", pa.bool_()), ("out1", pa.bool_()), ("n0", pa.int64()), ("n1", pa.int64()), ("header", pa.string())])

        key, found = None, None
        for file, block, part in by_blocks(batches):
            if key != (file, block):
                if found:
                    yield row(key, found)
                key, found = (file, block), Summary(block)
            found.take(part.column("value"))
        if found:
            yield row(key, found)

    return lines.mapInArrow(run, "file string, block long, out0 boolean, out1 boolean, n0 long, n1 long, header string")


def entries(ends: DataFrame) -> DataFrame:
    """file, block, inside (whether the block begins inside quotes), leaves (whether it ends so), base (records begun before), header."""
    by_block = Window.partitionBy("file").orderBy("block")
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    # a block sets the state whatever it was, swaps it, or leaves it
    sets, swaps = F.col("out0") == F.col("out1"), F.col("out0") & ~F.col("out1")
    turned = ends.withColumn("turns", F.sum(swaps.cast("long")).over(by_block.rowsBetween(Window.unboundedPreceding, 0)))
    last = turned.withColumn("set", F.last(F.when(sets, F.struct("out0", "turns")), ignorenulls=True).over(before)).withColumn("past", F.coalesce(F.lag("turns").over(by_block), F.lit(0)))
    odd = (F.col("past") - F.coalesce("set.turns", F.lit(0))) % 2 == 1
    pick = lambda a, b: F.when(F.col("inside"), F.col(b)).otherwise(F.col(a))
    known = last.withColumn("inside", F.coalesce("set.out0", F.lit(False)) != odd)
    return known.select("file", "block", "inside", pick("out0", "out1").alias("leaves"), F.coalesce(F.sum(pick("n0", "n1")).over(before), F.lit(0)).alias("base"), "header")


def parsed(text: str):
    return None if len(text) > MOST_CHARS else next(csv.reader(io.StringIO(text, newline="")), [])


RECORD = "file string, number long, text string, cells array<string>, block long, line long"


class Cutter:
    """Cuts the lines of a block into rows of (number, text, cells, line).

    text is a record without quotes, still whole; cells are those of other records.  Parts of records that begin
    before the block or go on after it have a text and, as `line`, the number of their first line.
    """

    def __init__(self, block: int, inside: bool, base: int):
        self.first, self.inside, self.number, self.line = block == 0, inside, base, 0
        self.held: list[str] | None = [] if inside else None
        self.since, self.cut = 0, inside

    def take(self, values: pa.Array):
        """(numbers, texts, cells, lines) of the records that end in these lines."""
        values, lone = split_returns(values)
        blank, quoted = blanks(values), quotes(values)
        size = len(values)
        if self.first and size:
            blank[0], self.first = False, False
        if self.held is None and not quoted.any() and not blank.any():
            numbers = np.arange(self.number, self.number + size)
            self.number += size
            self.line += size
            return numbers, pc.replace_substring_regex(values, "\r$", ""), None, None
        rows = []
        for i, (line, empty, has) in enumerate(zip(values.to_pylist(), blank.tolist(), quoted.tolist(), strict=True)):
            if self.held is None:
                if empty:
                    continue
                if not has:
                    rows.append((self.number, line.rstrip("\r"), None, None))
                elif ends_inside(line, False):
                    self.held, self.since, self.cut = [line, "" if lone[i] else "\n"], self.line + i, False
                    continue
                else:
                    rows.append((self.number, None, parsed(line), None))
                self.number += 1
                continue
            self.held += [line, "" if lone[i] else "\n"]
            if has and not ends_inside(line, True):
                rows.append(self.finish())
        self.line += size
        return tuple(zip(*rows, strict=True)) if rows else ((), (), (), ())

    def finish(self):
        """The row of what is held; its record began here, or goes on from an earlier block."""
        text, cut, self.held = "".join(self.held), self.cut, None
        if cut:
            self.cut = False
            return self.number - 1, text, None, 0
        self.number += 1
        return self.number - 1, None, parsed(text), None

    def rest(self):
        """The row of what is still held at the block's end."""
        if self.held:
            text = "".join(self.held)
            return (self.number - 1, text, None, 0) if self.cut else (self.number, text, None, self.since)
        return None


def cut(lines: DataFrame, parts: bool) -> DataFrame:
    """Rows of `RECORD` of the lines, which have inside and base of their block: whole records, or the parts of others."""

    def run(batches):
        csv.field_size_limit(sys.maxsize)

        def batch_of(key, numbers, texts, cells, at):
            size = len(numbers)
            nulls = lambda kind: pa.nulls(size, kind)
            texts = texts if isinstance(texts, pa.Array | pa.ChunkedArray) else pa.array(texts, pa.string())
            arrays = [pa.array([key[0]], pa.string()).take(pa.array(np.zeros(size, np.int64))), pa.array(numbers, pa.int64()), texts, nulls(pa.list_(pa.string())) if cells is None else pa.array(cells, pa.list_(pa.string())), pa.array(np.full(size, key[1], np.int64)), nulls(pa.int64()) if at is None else pa.array(at, pa.int64())]
            out = pa.RecordBatch.from_arrays(arrays, ["file", "number", "text", "cells", "block", "line"])
            if parts:
                return out.filter(out.column("line").is_valid())
            return out if at is None else out.filter(out.column("line").is_null())

        key, cutter = None, None
        for file, block, part in by_blocks(batches):
            if key != (file, block):
                if cutter and (row := cutter.rest()):
                    yield batch_of(key, *([x] for x in row))
                key, cutter = (file, block), Cutter(block, part.column("inside")[0].as_py(), part.column("base")[0].as_py())
            yield batch_of(key, *cutter.take(part.column("value")))
        if cutter and (row := cutter.rest()):
            yield batch_of(key, *([x] for x in row))

    return lines.select("file", "block", "value", "inside", "base").mapInArrow(run, RECORD)


def stitched(parts: DataFrame) -> DataFrame:
    """Records whose parts lie in several blocks."""
    sizes = parts.groupBy("file", "number").agg(F.sum(F.length("text")).alias("size"))
    small = parts.join(sizes.where(F.col("size") <= MOST_CHARS), ["file", "number"], "left_semi")
    joined = small.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("parts"))

    def run(batches):
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            cells = [parsed(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("number"), pa.array(cells, pa.list_(pa.string()))], ["file", "number", "cells"])

    whole = joined.select("file", "number", F.array_join(F.col("parts.text"), "").alias("text")).mapInArrow(run, "file string, number long, cells array<string>")
    return whole.unionByName(sizes.where(F.col("size") > MOST_CHARS).select("file", "number", F.lit(None).cast("array<string>").alias("cells")))


def split_csv(spark: SparkSession, paths) -> CsvFiles:
    """All records of the files, and their headers."""
    lines = scan(spark, paths)
    known = materialize(entries(summaries(lines)), "csv-blocks")
    found = known.agg(F.count("*").alias("blocks"), F.max(F.col("inside") | F.col("leaves")).alias("edges"), F.max((F.col("block") == 0) & F.col("header").isNull()).alias("quoted")).first()
    few = found.blocks <= BROADCAST_ROWS

    def bare(text):
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ",", -1))

    def with_entry(blocks: DataFrame) -> DataFrame:
        if few:
            return lines.join(F.broadcast(blocks), ["file", "block"])  # keeps the order of lines
        ordered = lines.withColumn("order", F.monotonically_increasing_id()).join(blocks, ["file", "block"])
        return ordered.repartition("file", "block").sortWithinPartitions("file", "block", "order")

    def records(blocks: DataFrame) -> DataFrame:
        whole = cut(with_entry(blocks), parts=False)
        text = F.col("text")
        cells = F.when(text.isNull(), F.col("cells")).otherwise(bare(text))
        return whole.select("file", "number", cells.alias("cells"))

    every, headers = records(known), known.where("block = 0 AND header IS NOT NULL").select("file", bare(F.col("header")).alias("header"))
    if found.quoted:
        heads = records(known.where("block = 0 AND header IS NULL")).where("number = 0").select("file", F.col("cells").alias("header"))
        headers = headers.unionByName(materialize(heads, "csv-headers"))
    if found.edges:
        over = materialize(stitched(cut(with_entry(known.where("inside OR leaves")), parts=True)), "csv-edges")
        every, headers = every.unionByName(over), headers.unionByName(over.where("number = 0").select("file", F.col("cells").alias("header")))
    return CsvFiles(every.where("number > 0").withColumnRenamed("number", "record_number"), headers)


def named(found: CsvFiles, columns: list[str]) -> DataFrame:
    """file, record_number and the cells under the names `columns`, wherever each file's header has them.

    A name that a header lacks, and a cell that a row lacks, is null; of a repeated name the last counts; cells
    beyond the header drop out.
    """
    place = lambda name: F.size("header") - F.array_position(F.reverse("header"), name)
    kinds = found.headers.select("header").distinct().take(2)
    if len(kinds) == 1 and kinds[0].header is not None:
        last = {name: i for i, name in enumerate(kinds[0].header)}
        return found.records.select("file", "record_number", *(F.get("cells", F.lit(last.get(c, -1))).alias(c) for c in columns))
    at = found.headers.select("file", *(F.when(F.array_contains("header", c), place(c)).otherwise(-1).cast("int").alias(f"_at{i}") for i, c in enumerate(columns)))
    at = F.broadcast(at) if at.count() <= BROADCAST_ROWS else at
    return found.records.join(at, "file").select("file", "record_number", *(F.get("cells", F.col(f"_at{i}")).alias(c) for i, c in enumerate(columns)))
