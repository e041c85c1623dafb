"""Media columns: texts as 8-bit greyscale PNG members of ZIP archives, read back by a custom data source.

The data source plans byte ranges over each archive; a task reads the archive's directory (at its end), takes the
members whose headers begin in its range, and streams them as Arrow batches. A member that cannot be read or fails
its checksum is retried on its own, from its offset, over a fresh connection; after that it raises, or with option
``onError=row`` becomes a row with the error.

A payload is the text as UTF-8 (null: empty), padded with bytes 255 to a positive multiple of ``row`` bytes; a pixel
row is ``row`` bytes. Null ids are written as such. Equal texts give equal media and features.
"""

from __future__ import annotations

import hashlib
import io
import struct
import time
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from .archive_io import MANIFEST, Range, listed, manifest_of, place, ranges, write_file
from .common import integral, prepare, scratch

_SIGN = b"\x89PNG\r\n\x1a\n"


@dataclass(frozen=True)
class Settings:
    row: int = 576
    level: int = 1  #: of zlib
    archive: int = 24 << 20  #: bytes of media after which a task begins another archive
    range: int = 8 << 20  #: bytes of archive a reading task owns
    batch: int = 4 << 20
    retries: int = 3
    piece: int = 4096  #: pixel rows compressed at a time


def pad(data: bytes, to: int) -> bytes:
    return data + b"\xff" * (to - len(data) if len(data) <= to else -len(data) % to)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, s: Settings) -> bytes:
    """payload: a positive multiple of s.row bytes."""
    height = len(payload) // s.row
    out = [_SIGN, _chunk(b"IHDR", struct.pack(">IIBBBBB", s.row, height, 8, 0, 0, 0, 0))]
    deflate = zlib.compressobj(s.level)
    pixels = np.frombuffer(payload, np.uint8).reshape(height, s.row)
    for at in range(0, height, s.piece):
        part = pixels[at : at + s.piece]
        lines = np.zeros((len(part), s.row + 1), np.uint8)  # each line begins with filter 0
        lines[:, 1:] = part
        data = deflate.compress(lines.tobytes())
        if data:
            out.append(_chunk(b"IDAT", data))
    return b"".join([*out, _chunk(b"IDAT", deflate.flush()), _chunk(b"IEND", b"")])


def from_png(media: bytes) -> np.ndarray:
    """Pixels, a line a row. Checks chunk checksums; reads unfiltered 8-bit greyscale."""
    if media[:8] != _SIGN:
        raise ValueError("not a PNG")
    at, data, width, height = 8, [], 0, 0
    while at < len(media):
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        body = media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            width, height, *rest = struct.unpack(">IIBBBBB", body)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("unsupported pixels")
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("unsupported filter")
    return lines[:, 1:]


def features(pixels: np.ndarray) -> str:
    """Size, mean, deviation, entropy and an 8 x 8 average hash."""
    h, w = pixels.shape
    counts = np.bincount(pixels.reshape(-1), minlength=256).astype(float)
    share = counts[counts > 0] / pixels.size
    mean = (counts * np.arange(256)).sum() / pixels.size
    deviation = np.sqrt(max(0.0, (counts * np.arange(256) ** 2).sum() / pixels.size - mean**2))
    edge = np.arange(9) * w // 8
    columns = np.add.reduceat(pixels, edge[:-1], axis=1, dtype=np.int64)
    sums = np.vstack([np.zeros((1, 8), np.int64), np.cumsum(columns, 0)])
    top = np.arange(8) * h // 8
    bottom = np.maximum(top + 1, np.arange(1, 9) * h // 8)
    blocks = (sums[bottom] - sums[top]) / ((bottom - top)[:, None] * np.diff(edge)[None, :])
    bits = np.packbits((blocks > mean).reshape(-1)).tobytes().hex()
    return f"{w}x{h};mean={mean:.3f};std={deviation:.3f};entropy={-(share * np.log2(share)).sum():.3f};ahash={bits}"


def write(docs: DataFrame, s: Settings = Settings(), folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"):
    """Writes every row's text as a member of an archive in folder. Returns the manifest as a Table."""
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or scratch(spark, "media")

    def run(batches):
        def store():
            z.close()
            data = held.getvalue()
            return pa.record_batch({"path": pa.array([write_file(folder, ".zip", data)]), "size": pa.array([len(data)], pa.int64()), "members": pa.array([n], pa.int64())})

        held, n = io.BytesIO(), 0
        z = zipfile.ZipFile(held, "w", zipfile.ZIP_STORED)
        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                z.writestr(zipfile.ZipInfo(f"{n}/{'null' if i is None else i}.png"), to_png(pad(text or b"", s.row), s))
                n += 1
                if held.tell() >= s.archive:
                    yield store()
                    held, n = io.BytesIO(), 0
                    z = zipfile.ZipFile(held, "w", zipfile.ZIP_STORED)
        if n:
            yield store()

    return manifest_of(docs.select(integral(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, MANIFEST), "media-manifest")


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    size: int
    crc: int


def directory(file, size: int) -> list[Member]:
    """The members of a ZIP archive, from its directory."""
    tail = min(size, (1 << 16) + 22)
    file.seek(size - tail)
    end = file.read(tail)
    at = end.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no archive directory")
    count, length, start = struct.unpack("<HII", end[at + 10 : at + 20])
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):  # the 64-bit form
        where = struct.unpack("<Q", end[end.rfind(b"PK\x06\x07", 0, at) + 8 :][:8])[0]
        file.seek(where)
        length, start = struct.unpack("<QQ", file.read(56)[40:56])
    file.seek(start)
    data, out, p = file.read(length), [], 0
    while p < len(data):
        method, crc, packed, plain, n, extra, comment, offset = struct.unpack("<10xH4xIIIHHH8xI", data[p : p + 46])
        name = data[p + 46 : p + 46 + n].decode()
        more = data[p + 46 + n : p + 46 + n + extra]
        while len(more) >= 4:
            kind, m = struct.unpack("<HH", more[:4])
            if kind == 1:
                values = [x[0] for x in struct.iter_unpack("<Q", more[4 : 4 + m - m % 8])]
                plain = values.pop(0) if plain == 0xFFFFFFFF else plain
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                offset = values.pop(0) if offset == 0xFFFFFFFF else offset
            more = more[4 + m :]
        if method:
            raise ValueError("members are stored, not compressed")
        out.append(Member(name, offset, packed, crc))
        p += 46 + n + extra + comment
    return out


def read_member(file, m: Member) -> bytes:
    file.seek(m.offset)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no member at the offset")
    n, extra = struct.unpack("<HH", head[26:30])
    file.seek(m.offset + 30 + n + extra)
    data = file.read(m.size)
    if len(data) != m.size or zlib.crc32(data) != m.crc:
        raise ValueError("damaged member")
    return data


class MediaReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        s = Settings()
        self.options = dict(options)
        self.each, self.batch = int(options.get("rangeBytes", s.range)), int(options.get("batchBytes", s.batch))
        self.retries, self.rows = int(options.get("retries", s.retries)), options.get("onError", "raise") == "row"

    def partitions(self):
        return ranges(listed(self.options, ".zip"), self.each)

    def read(self, part) -> Iterator[pa.RecordBatch]:
        known: tuple[str, list[Member]] = ("", [])
        for one in part.items:
            opened = [self.open(one.path)]
            if known[0] != one.path:
                known = one.path, self.again(opened, one.path, lambda f, one=one: directory(f, one.size))
            yield from self.members(opened, one, known[1])
            opened[0].close()

    def members(self, opened: list, part: Range, directory: list[Member]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for m in directory:
            if part.start <= m.offset < part.end:
                try:
                    data, error = self.again(opened, part.path, lambda f, m=m: read_member(f, m)), None
                except (OSError, ValueError) as e:
                    if not self.rows:
                        raise
                    data, error = None, str(e)
                held.append((part.path, m.offset, m.name, data, error))
                size += m.size
                if size >= self.batch:
                    yield self.rows_of(held)
                    held, size = [], 0
        if held:
            yield self.rows_of(held)

    @staticmethod
    def open(path: str):
        files, name = place(path)
        return files.open_input_file(name)

    def again(self, opened: list, path: str, step):
        for n in range(self.retries + 1):
            try:
                return step(opened[0])
            except (OSError, ValueError):
                if n == self.retries:
                    raise
                time.sleep(0.05 * 2**n)
                opened[0].close()
                opened[0] = self.open(path)

    @staticmethod
    def rows_of(held: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], ["archive", "offset", "member", "media", "error"])


class MediaArchives(DataSource):
    """spark.read.format("quillstream_media"), with option path (a folder) or manifest (a table of archives)."""

    @classmethod
    def name(cls) -> str:
        return "quillstream_media"

    def schema(self) -> str:
        return "archive string, offset long, member string, media binary, error string"

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options)


def read(spark, s: Settings = Settings(), **options: str) -> DataFrame:
    """Members of archives: archive, offset, member, media, error."""
    prepare(spark)
    spark.dataSource.register(MediaArchives)
    return spark.read.format("quillstream_media").options(rangeBytes=str(s.range), batchBytes=str(s.batch), retries=str(s.retries), **options).load()


def describe(members: DataFrame) -> DataFrame:
    """(doc_id, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, n_bytes, error) of read members.

    n_bytes is what the payload has before its padding: no UTF-8 text holds a byte 255.
    """

    def run(batches):
        for b in batches:
            rows = []
            for name, media, error in zip(*(b.column(c).to_pylist() for c in ("member", "media", "error"))):
                key = name.rpartition("/")[2].removesuffix(".png")
                key = None if key == "null" else int(key)
                if media is None:
                    rows.append((key, *[None] * 7, error))
                    continue
                pixels = from_png(media)
                payload = pixels.tobytes()
                rows.append((key, len(payload.rstrip(b"\xff")), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), features(pixels), None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in shape.split(", ")])

    shape = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"
    return members.select("member", "media", "error").mapInArrow(run, shape)


def media(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all rows' media, reads them back and describes them."""
    made = write(docs, s, None, id_col, text_col)
    return describe(read(docs.sparkSession, s, manifest=made.path))
