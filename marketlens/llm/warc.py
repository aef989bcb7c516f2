"""WARC archives: writing pages as records, and reading by boundary-chain verification.

A record's magic may also stand inside a payload, so a reader that starts in the middle of a file cannot trust it. Tasks
read byte ranges and emit each candidate record (place of a magic with a well-formed header), its successor (the end its
length declares) and its exit (the first place on its chain of successors beyond the range). Pointer jumping from the
start of each file, which is a record for certain, doubles the length of the verified chain each round; a range keeps the
one entry that is reached, if any, and reads on from there. Candidates that are not reached are dropped.

Pages with equal payloads of at least a given size share one response record, that of the largest page_id; the others are
revisit records without payload. Null html is an empty payload. Repeated rows of the largest page_id are all responses. A row
without page_id has a record with an id of its own, which reads back as null; it revisits the response if any row of its
payload has a page_id, and is a response otherwise. An empty table makes no archives. Carriage returns and line feeds in a URL are percent-encoded in the header; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, opened, slices, small, table, written

MAGIC = b"WARC/1.0\r\n"
#: A new archive begins after so many bytes; ranges that tasks read have so many.
ARCHIVE_BYTES, RANGE_BYTES = 1 << 28, 1 << 23
READ_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, with the digest and the length of the full payload; a revisit has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:{f'uuid:{uuid.uuid4()}' if page_id is None else f'page:{page_id}'}>",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return MAGIC + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def shared(pages: DataFrame, least_bytes: int) -> DataFrame:
    """sha, response (the largest page_id) of the payloads that several rows have. Counted in each task before the shuffle."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.where(F.octet_length(payload) >= least_bytes).select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload.cast("binary")).alias("sha"))
    return written(rows.groupBy("sha").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1 and response is not null").select("sha", "response"), "shared")


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes the archives; returns a row for each: path, size. Files of tasks that are repeated stay unlisted.

    Where the shared payloads are too many to broadcast, pages are shuffled by digest to meet them; a digest of very many pages
    is a skewed partition on the one side and one row on the other, which Spark's adaptive join splits."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("sha"))
    later = F.col("page_id").isNull() | (F.col("page_id") < F.col("response"))
    rows = rows.join(small(shared(pages.select("page_id", "html"), least_bytes)), "sha", "left").select("page_id", "url", "html", F.when(later, F.col("response")).alias("refers_to"))
    system, top = opened(folder)
    system.create_dir(top, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        stream, name, size, done = None, "", 0, []
        for batch in slices(batches):
            for page_id, url, html, refers_to in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if stream is None:
                    name, size = f"{uuid.uuid4().hex}.warc", 0
                    stream = system.open_output_stream(f"{top}/{name}")
                raw = record(page_id, url, html.encode(), refers_to)
                stream.write(raw)
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    stream.close()
                    done.append((name, size))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((name, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["path", "size"])

    return written(rows.mapInArrow(run, "path string, size long"), "archives")


class Bytes:
    """A file's bytes from a place on, read in steps as they are asked for."""

    def __init__(self, source, at: int, size: int):
        self.source, self.at, self.size, self.held = source, at, size, b""

    def until(self, end: int) -> bytes:
        """The bytes from `at` to `end` or the end of the file, at least."""
        if (missing := min(end, self.size) - self.at - len(self.held)) > 0:
            self.source.seek(self.at + len(self.held))
            self.held += self.source.read(missing)
        return self.held

    def drop(self, to: int) -> None:
        self.until(to)
        self.held, self.at = self.held[to - self.at :], to

    def header(self, at: int) -> tuple[dict[bytes, bytes], int] | None:
        """The header fields of a record at a place, and where its block begins; None if there is no such header."""
        step = READ_BYTES
        while True:
            raw = self.until(at + step)
            if raw[at - self.at :][: len(MAGIC)] != MAGIC:
                return None
            end = raw.find(b"\r\n\r\n", at - self.at)
            if end >= 0:
                break
            if at + step >= self.size:
                return None
            step *= 4
        lines = raw[at - self.at + len(MAGIC) : end].split(b"\r\n")
        fields = dict(line.split(b": ", 1) for line in lines if b": " in line)
        return (fields, self.at + end + 4) if re.fullmatch(rb"[0-9]{1,18}", fields.get(b"Content-Length", b"")) and b"WARC-Type" in fields else None


def _successor(data: Bytes, at: int) -> int | None:
    found = data.header(at)
    if found and (end := found[1] + int(found[0][b"Content-Length"]) + 4) <= data.size:
        return end
    return None


def ranges(archives: DataFrame) -> DataFrame:
    """path, size, first, last: the ranges of each archive."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(RANGE_BYTES).cast("long")))
    rows = archives.where("size > 0").select("path", "size", starts.alias("first")).withColumn("last", F.least(F.col("first") + RANGE_BYTES, "size"))
    return rows.repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "first")


def boundaries(archives: DataFrame, folder: str) -> DataFrame:
    """path, size, place, successor, exit of each candidate record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                found: dict[int, int] = {}
                with system.open_input_file(f"{top}/{row['path']}") as source:
                    data, at = Bytes(source, row["first"], row["size"]), row["first"]
                    while at < row["last"]:
                        # A step at a time; a magic may begin in one step and end in the next.
                        raw = data.until(min(at + (1 << 20), row["last"]) + len(MAGIC) - 1)
                        for m in re.finditer(re.escape(MAGIC), raw):
                            place = data.at + m.start()
                            if place < row["last"] and place not in found and (end := _successor(data, place)) is not None:
                                found[place] = end
                        at = min(at + (1 << 20), row["last"])
                        data.drop(max(data.at, at - len(MAGIC) + 1))
                exits: dict[int, int] = {}
                for place in sorted(found, reverse=True):
                    exits[place] = exits.get(found[place], found[place])
                rows = [(row["path"], row["size"], p, found[p], exits[p]) for p in sorted(found)]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], ["path", "size", "place", "successor", "exit"])

    return written(ranges(archives).mapInArrow(run, "path string, size long, place long, successor long, exit long"), "boundaries")


def entries(candidates: DataFrame, archives: DataFrame) -> DataFrame:
    """path, place: the first record of each range that a chain from the file's start reaches."""
    jumps = candidates.select("path", "place", F.col("exit").alias("to"))
    reached = written(archives.where("size > 0").select("path", F.lit(0).cast("long").alias("place")), "reached")
    count = reached.count()
    while True:
        further = reached.join(jumps, ["path", "place"]).select("path", F.col("to").alias("place"))
        reached = written(reached.union(further).distinct(), "reached")
        if (now := reached.count()) == count:
            return reached
        count = now
        second = jumps.select("path", F.col("place").alias("to"), F.col("to").alias("end"))
        jumps = written(jumps.join(second, ["path", "to"]).select("path", "place", F.col("end").alias("to")), "jumps")


def read(archives: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, and payload_ok (the payload has its digest; null for a
    revisit) of every record. A file whose chain breaks off before its end fails."""
    known = entries(boundaries(archives, folder), archives).where("place is not null")
    spans = ranges(archives).join(known, ["path"]).where((F.col("place") >= F.col("first")) & (F.col("place") < F.col("last")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                rows, at = [], row["place"]
                with system.open_input_file(f"{top}/{row['path']}") as source:
                    data = Bytes(source, at, row["size"])
                    while at < row["last"]:
                        found = data.header(at)
                        if found is None:
                            raise ValueError(f"{row['path']} has no record at {at}")
                        fields, block = found
                        end = block + int(fields[b"Content-Length"])
                        raw = data.until(end + 4)[block - data.at : end - data.at]
                        http, _, payload = raw.partition(b"\r\n\r\n")
                        length = int(re.search(rb"(?m)^Content-Length: ([0-9]+)", http)[1])
                        digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
                        kind = fields[b"WARC-Type"].decode()
                        number = lambda name, fields=fields: int(m[1]) if (m := re.fullmatch(rb"<urn:page:(-?[0-9]+)>", fields.get(name, b""))) else None
                        ok = base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest and len(payload) == length if kind == "response" else None
                        rows.append((number(b"WARC-Record-ID"), length, digest, kind, number(b"WARC-Refers-To"), ok))
                        at = end + 4
                        data.drop(at)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload_ok"])

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spans.repartition(parts, "path", "first").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload_ok boolean")


def write_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    folder = new_path(pages.sparkSession, "warc")
    return read(write(pages, folder, least_bytes), folder)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    return write_and_read(table(spark, sf_dir, "pages"))
