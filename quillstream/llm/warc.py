"""WARC: a writer, and a splittable reader as a custom data source.

Records are gzip members of their own. The reader plans byte ranges; a task scans its range for gzip magic, accepts a
candidate if it inflates, its header is a WARC header with a length that fits, and the file ends or another member
begins right after it; it owns the records that start inside its range, reading the last one past the range's end.
A record that fails is retried from its offset.

Rows with equal payloads of at least ``least`` bytes are written once: the one with the smallest page_id as response,
the others as revisits that refer to it. Rows with that same smallest id are all responses; null ids come after all
others, and if all are null all are responses. A null html is an empty payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from .archive_io import MANIFEST, Range, listed, manifest_of, place, ranges, write_file
from .common import integral, prepare, scratch

_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


@dataclass(frozen=True)
class Settings:
    least: int = 0
    level: int = 6
    archive: int = 16 << 20
    range: int = 4 << 20
    batch: int = 4 << 20
    retries: int = 3
    date: str = "2024-01-01T00:00:00Z"
    read_bytes: int = 1 << 18


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, refers: int | None, revisit: bool, s: Settings) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page)}", f"WARC-Date: {s.date}"]
    if url:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (lower case) and block of a record; None if it is not one."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or not sep:
        return None
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    n = int(fields["content-length"])
    return (fields, rest[:n]) if len(rest) >= n and rest[n:] == b"\r\n\r\n" else None


def write(pages: DataFrame, s: Settings = Settings(), folder: str | None = None):
    """pages: (page_id, url, html). Writes a record for each row; returns the manifest as a Table.

    A digest's rows meet in one join whose other side has a row for each repeated payload; a hot payload's rows are
    split by adaptive execution, as that side is small there. The manifest's rows, one an archive, are written by one
    task: otherwise each writing task leaves a table file of a row or so, for which Hadoop's local file system starts
    processes from the executor.
    """
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or scratch(spark, "warc")
    rows = pages.select(integral(pages, "page_id").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    first = rows.where(F.octet_length("html") >= s.least).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("sha").alias("same"), "first")
    linked = rows.join(first, F.col("sha") == F.col("same"), "left")
    linked = linked.select("page_id", "url", "html", "first", (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches):
        held, size, n = [], 0, 0

        def store():
            data = b"".join(held)
            return pa.record_batch({"path": pa.array([write_file(folder, ".warc.gz", data)]), "size": pa.array([len(data)], pa.int64()), "members": pa.array([n], pa.int64())})

        for b in batches:
            for page, url, html, refers, revisit in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "first", "revisit"))):
                held.append(gzip.compress(record(page, url, html.encode(), refers, revisit, s), s.level, mtime=0))
                size, n = size + len(held[-1]), n + 1
                if size >= s.archive:
                    yield store()
                    held, size, n = [], 0, 0
        if n:
            yield store()

    return manifest_of(linked.mapInArrow(run, MANIFEST).repartition(1), "warc-manifest")


class _File:
    """Bytes of a file by offset, through one buffer."""

    def __init__(self, path: str, size: int, each: int):
        self.path, self.size, self.each, self.at, self.data = path, size, each, 0, b""
        self.open()

    def open(self) -> None:
        files, name = place(self.path)
        self.file, self.data = files.open_input_file(name), b""

    def close(self) -> None:
        self.file.close()

    def get(self, start: int, n: int) -> bytes:
        if not (self.at <= start and start + n <= self.at + len(self.data)):
            self.file.seek(start)
            self.at, self.data = start, self.file.read(min(max(n, self.each), self.size - start))
        return self.data[start - self.at : start - self.at + n]


def inflate(file: _File, at: int) -> tuple[bytes, int] | None:
    """The gzip member at an offset, and where it ends; None if there is none."""
    z, out, where, seen = zlib.decompressobj(31), [], at, 0
    try:
        while not z.eof:
            data = file.get(where, min(file.each, file.size - where))
            if not data:
                return None
            out.append(z.decompress(data))
            where += len(data)
            if not seen and sum(map(len, out)) >= 7:
                seen = 1
                if not b"".join(out).startswith(b"WARC/1."):  # a false start is left early
                    return None
    except zlib.error:
        return None
    return b"".join(out), where - len(z.unused_data)


def owned(file: _File, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header, block) of the records that start in [start, end)."""
    at, known = start, start == 0
    while at < end:
        if not known:
            window = file.get(at, min(file.each, end + 2 - at, file.size - at))
            found = window.find(_MAGIC)
            if found < 0:
                at += max(1, len(window) - 2)
                continue
            at += found
            if at >= end:
                return
        member = inflate(file, at)
        parsed = parse(member[0]) if member else None
        if parsed and (member[1] == file.size or file.get(member[1], min(3, file.size - member[1])) == _MAGIC):
            yield at, *parsed
            at, known = member[1], True
        elif known:
            raise ValueError(f"no record at {at} of {file.path}")
        else:
            at += 1


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        s = Settings()
        self.options = dict(options)
        self.each, self.batch, self.retries, self.read_bytes = (int(options.get(k, d)) for k, d in (("rangeBytes", s.range), ("batchBytes", s.batch), ("retries", s.retries), ("readBytes", s.read_bytes)))

    def partitions(self):
        return ranges(listed(self.options, ".warc.gz"), self.each)

    def read(self, part) -> Iterator[pa.RecordBatch]:
        for one in part.items:
            yield from self.records(one)

    def records(self, part: Range) -> Iterator[pa.RecordBatch]:
        held, size, done, tries = [], 0, part.start, 0
        file = _File(part.path, part.size, self.read_bytes)
        while True:
            try:
                for at, fields, block in owned(file, part.start, part.end):
                    if at < done:  # yielded before a retry
                        continue
                    held.append((part.path, at, fields, block))
                    size, done, tries = size + len(block), at + 1, 0
                    if size >= self.batch:
                        yield self.rows_of(held)
                        held, size = [], 0
                break
            except (OSError, ValueError):
                tries += 1
                if tries > self.retries:
                    raise
                time.sleep(0.05 * 2**tries)
                file.close()
                file.open()
        file.close()
        if held:
            yield self.rows_of(held)

    @staticmethod
    def rows_of(held: list) -> pa.RecordBatch:
        path, at, fields, block = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(at, pa.int64()), pa.array([list(f.items()) for f in fields], pa.map_(pa.string(), pa.string())), pa.array(block, pa.binary())], ["archive", "offset", "header", "block"])


class WarcArchives(DataSource):
    """spark.read.format("quillstream_warc"), with option path (a folder) or manifest (a table of archives)."""

    @classmethod
    def name(cls) -> str:
        return "quillstream_warc"

    def schema(self) -> str:
        return "archive string, offset long, header map<string, string>, block binary"

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read(spark, s: Settings = Settings(), **options: str) -> DataFrame:
    """Records of archives: archive, offset, header (names in lower case), block."""
    prepare(spark)
    spark.dataSource.register(WarcArchives)
    return spark.read.format("quillstream_warc").options(rangeBytes=str(s.range), batchBytes=str(s.batch), retries=str(s.retries), readBytes=str(s.read_bytes), **options).load()


def describe(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), checked: a response's payload has its digest."""

    def number(name: str | None) -> int | None:
        value = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if re.fullmatch(r"-?\d+", value) else None

    def run(batches):
        for b in batches:
            rows = []
            for header, block in zip(b.column("header").to_pylist(), b.column("block").to_pylist()):
                f = dict(header)
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
                said = f["warc-payload-digest"].removeprefix("sha1:")
                if f["warc-type"] == "response" and (len(payload) != length or digest(payload) != said):
                    raise ValueError(f"payload of {f['warc-record-id']} is damaged")
                rows.append((number(f["warc-record-id"]), length, said, f["warc-type"], number(f.get("warc-refers-to"))))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return records.select("header", "block").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Writes all pages and reads them back."""
    made = write(pages, s)
    return describe(read(pages.sparkSession, s, manifest=made.path))
