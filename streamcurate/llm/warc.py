"""WARC archives, and the converter of legacy ARC archives to them.

ARC files are read as they were written: a version line tells which header line the records carry
(version 1: URL, IP, date, type, length; version 2 adds result code, checksum, location, offset and
file name), and each record's declared length delimits its body.  The converter then makes what WARC
wants and ARC lacks: a record id derived from the record's place and content, a W3C timestamp, the
record type and the payload digest.

Both kinds of archive are written by Spark's text sink, records joined by the separator that ends one
(CRLF CRLF for WARC, LF for ARC), so any store Spark writes to will do.  A file takes records up to
about `FILE_BYTES`, however long single ones are, and is read as one binary row.

Defined cases: a null html is an empty payload; payloads equal in bytes form one group, the largest
page_id of which is the response and the others revisits, from `revisit_from` payload bytes on;
repeated rows with equal page_id are told apart by their place in the archives, so one of them is the
response; a null page_id sorts below all others and stays null; an empty table gives an empty result;
other columns are kept out of the archives.  In archives from elsewhere, a line that should be an ARC
header and isn't one is skipped, and so is what stands between WARC records; a record that the end of
its file cuts off is left out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, materialize, remove, shared_dir

#: Payload bytes from which equal payloads become revisits.
REVISIT_FROM = 0
#: Field names of the two ARC header lines.
ARC_V1 = "URL IP-address Archive-date Content-type Archive-length"
ARC_V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
CAPTURED = "20240101000000"
#: Bytes of one archive file, about, before compression; a longer record is a file of its own.
FILE_BYTES = 16 << 20
#: Up to so many groups of equal payloads are broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 200_000


def new_path(spark, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def write_lines(df: DataFrame, column: str, separator: str, path: str) -> None:
    """Files of the column's strings, each ended by the separator."""
    between = separator.encode()

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for record in binaries(batch.column(0)):
                if held and size + len(record) > FILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([between.join(held)], pa.large_binary())], ["file"])
                    held, size = [], 0
                held.append(record)
                size += len(record) + len(between)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([between.join(held)], pa.large_binary())], ["file"])

    files = df.select(F.col(column).cast("binary").alias("record")).mapInArrow(run, "file binary").select(F.col("file").cast("string").alias("file"))
    # fast compression: archives are written twice and read once
    files.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path)


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """Legacy archives of the pages: a version block first, then header line and body of each page."""
    fields = ARC_V1 if version == 1 else ARC_V2
    named = f"{version} 0 synthetic\n{fields}\n"
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.concat(F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("urn:unknown")), r"\s", "%20"), F.lit("#page="), F.coalesce(F.col("page_id").cast("string"), F.lit("-")))
    middle = F.lit("0.0.0.0"), F.lit(CAPTURED), F.lit("text/html")
    more = (F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("synthetic.arc")) if version == 2 else ()
    header = F.concat_ws(" ", url, *middle, *more, F.octet_length(html).cast("string"))
    block = F.lit(f"filedesc://synthetic.arc 0.0.0.0 {CAPTURED} text/plain {'200 - - 0 synthetic.arc ' if version == 2 else ''}{len(named.encode())}\n{named}\n")
    # every record carries the version block before it, so every file starts with one
    lines = pages.select(F.concat(block, header, F.lit("\n"), html).alias("line"))
    write_lines(lines, "line", "\n", path)


def arc_header(line: bytes, names: list[str]) -> tuple[dict[str, str], int] | None:
    """Fields of a header line and the length it declares; None if it isn't one of this version."""
    values = line.decode("utf-8", "replace").rstrip("\r").split(" ")
    if not values[-1].isdecimal() or (len(values) != len(names) and not values[0].startswith("filedesc://")):
        return None
    return dict(zip(names, values, strict=False)) | {"URL": values[0]}, int(values[-1])


def arc_records(data: bytes):
    """(header fields as dict, body) of each record, by the declared lengths; filedesc blocks set the field names."""
    at, names = 0, ARC_V1.split()
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        stop = data.find(b"\n", at)
        if stop < 0:
            return
        found = arc_header(data[at:stop], names)
        at = stop + 1
        if found is None:
            continue
        fields, size = found
        body = data[at : at + size]
        at += size
        if len(body) < size:
            return
        if fields["URL"].startswith("filedesc://"):
            lines = body.decode("utf-8", "replace").split("\n")
            names = lines[1].split(" ") if len(lines) > 1 else names
            continue
        yield fields, body


def read_arc(spark, path: str) -> DataFrame:
    """page_id, url, date, content_type, payload, payload_digest and record_id of all records of ARC files."""
    names = ["page_id", "url", "date", "content_type", "payload", "payload_digest", "record_id"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string())

    def arrow(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist(), strict=True):
                held, size = [], 0
                for number, (fields, body) in enumerate(arc_records(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content)):
                    url, _, page = fields["URL"].rpartition("#page=")
                    page_id = int(page) if url and re.fullmatch(r"-?\d+", page) else None
                    url = url or fields["URL"]
                    date = fields.get("Archive-date", "")
                    held.append((page_id, url, date, fields.get("Content-type", ""), body, *digests(url, date, page_id, f"{file} {number}", body)))
                    size += len(body)
                    if size > 4 << 20:
                        yield arrow(held)
                        held, size = [], 0
                if held:
                    yield arrow(held)

    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"[^/]+$", 0).alias("file"), "content")
    return files.mapInArrow(run, "page_id long, url string, date string, content_type string, payload binary, payload_digest string, record_id string")


def digests(url: str, date: str, page, place: str, body: bytes) -> tuple[str, str]:
    """Payload digest (base32 SHA-1) and record id (a name-based UUID of place and content)."""
    sha = hashlib.sha1(body).digest()
    return base64.b32encode(sha).decode(), f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place} {page} {url} {date} {sha.hex()}')}"


def typed(records: DataFrame, revisit_from: int = REVISIT_FROM, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """Adds record_type and refers_to: of equal payloads the largest page_id is the response.

    The heads of groups come from a mergeable aggregate, never from a whole group in one task, and are
    written before they are joined, so that a payload of very many records can be split.
    """
    size = F.octet_length("payload")
    heads = records.where(size >= revisit_from).groupBy("payload_digest", size.alias("size")).agg(F.max(F.struct("page_id", "record_id")).alias("head"), F.count("*").alias("n")).where("n > 1")
    heads = materialize(heads.select(F.col("payload_digest").alias("of"), "size", F.col("head.page_id").alias("head_id"), F.col("head.record_id").alias("head_record")), "heads")
    few = heads.count() <= broadcast_groups
    out = records.join(F.broadcast(heads) if few else heads, (F.col("payload_digest") == F.col("of")) & (size == F.col("size")), "left")
    again = F.col("of").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("head_record"))
    return out.select(
        *records.columns,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("head_id")).alias("refers_to"),
        F.when(again, F.col("head_record")).alias("refers_record"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Archives of typed records (page_id, url, date, payload, payload_digest, record_id, record_type, refers_to)."""
    crlf = "\r\n"
    stamp = F.concat_ws("", *(x for a, b, s in ((1, 4, "-"), (5, 2, "-"), (7, 2, "T"), (9, 2, ":"), (11, 2, ":"), (13, 2, "Z")) for x in (F.substring("date", a, b), F.lit(s))))
    # a revisit keeps its payload's digest and length; its block is empty
    block = F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise("")

    def line(name, value):
        return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value, F.lit(crlf)))

    text = F.concat(
        F.lit(f"WARC/1.0{crlf}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        line("WARC-Date", stamp),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_record"), F.lit(">"))),
        line("X-Page-ID", F.col("page_id").cast("string")),
        line("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        line("X-Payload-Length", F.octet_length("payload").cast("string")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(crlf),
        block,
    )
    write_lines(records.select(text.alias("record")), "record", crlf * 2, path)


def warc_records(data: bytes):
    """(headers, block) of each record, by Content-Length."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        size = headers.get("Content-Length", "")
        if not size.isdecimal():
            at += 1
            continue
        at = stop + 4 + int(size)
        if at > len(data):
            return
        yield headers, data[stop + 4 : at]


def read_warc(spark, path: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest (recomputed for responses), record_id, block."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "block"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def arrow(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches):
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for content in batch.column("content").to_pylist():
                held, size = [], 0
                for h, block in warc_records(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content):
                    digest = h.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                    length = int(h.get("X-Payload-Length", len(block)))
                    if h.get("WARC-Type") == "response":
                        digest, length = base64.b32encode(hashlib.sha1(block).digest()).decode(), len(block)
                    held.append((number(h.get("X-Page-ID")), length, digest, h.get("WARC-Type"), number(h.get("X-Refers-To-Page-ID")), h.get("WARC-Record-ID"), h.get("WARC-Target-URI"), block))
                    size += len(block)
                    if size > 4 << 20:
                        yield arrow(held)
                        held, size = [], 0
                if held:
                    yield arrow(held)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, block binary")


def convert(spark, arc_path: str, warc_path: str, revisit_from: int = REVISIT_FROM) -> None:
    """ARC archives at `arc_path` to WARC archives at `warc_path`."""
    write_warc(typed(read_arc(spark, arc_path), revisit_from), warc_path)


def round_trip(pages: DataFrame, version: int = 2, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Pages as ARC archives, converted to WARC archives, read back: one row per page."""
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, version)
    convert(spark, arc, warc, revisit_from)
    remove(spark, arc)
    return read_warc(spark, warc)


def query(spark, sf_dir):
    from .common import table

    return round_trip(table(spark, sf_dir, "pages")).drop("block", "url", "record_id")


def oracle_sql() -> str:
    """DuckDB: SHA-1 as hex digits, five of them to four base32 letters."""
    five = "('0x' || substr(h, {at}, 5))::BIGINT"
    letters = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({five.format(at=5 * k + 1)} >> {shift}) & 31)::BIGINT + 1, 1)" for k in range(8) for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
  g AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, {letters} AS payload_digest, max(page_id) OVER (PARTITION BY t) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = head OR payload_bytes < {REVISIT_FROM} THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head AND payload_bytes >= {REVISIT_FROM} THEN head END AS refers_to FROM g"""

