"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks of ``chunk`` characters that overlap by ``overlap``, and each chunk is pre-tokenised on its
own. The pre-tokens of a chunk depend on its start only until they meet a boundary of the full text: a position in the
overlap that is a boundary for both neighbours is one of the full text's, as the pattern never looks back. There the
chunks are stitched, and the pre-tokens between stitches are encoded. Where an overlap holds no common boundary (a very
long pre-token), the text is pre-tokenised again from the last boundary that is known, over twice as much at each try.
Decoding concatenates the tokens' raw bytes.

A text of up to ``task`` bytes is stitched in the task that reads it, so it is not shuffled. Chunks (of ``far``
characters) of a longer one are dealt out, pre-tokenised wherever they land, and stitched by their ends: a chunk that
begins inside a pre-token meets the full text's boundaries within three pre-tokens (the pattern's classes end with their
runs), so its first three ends are not used to stitch it to the next, and neighbours without a common boundary are
joined into one piece. The pieces are then encoded as any text.

A null text counts as empty: no tokens. Special tokens are ordinary text. Rows that repeat keep their number; ids are
integers or null; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import integral, prepare

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Settings:
    path: str  #: rank file: base64 of a token's bytes, and its rank, a line
    pattern: str = PATTERN
    chunk: int = 2048
    overlap: int = 128
    task: int = 1 << 20  #: chunks of texts of more bytes are dealt out
    far: int = 1 << 16
    far_overlap: int = 1 << 10
    kept: int = 1 << 17  #: pre-tokens whose ids are kept at hand


@lru_cache(maxsize=4)
def _load(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=4)
def codec(s: Settings) -> Codec:
    return Codec(s)


class Codec(dict):
    """Encodes and decodes. As a dict: pre-tokens to their packed ids, the commonest kept."""

    def __init__(self, s: Settings):
        import regex
        import tiktoken

        super().__init__()
        self.s, self.ranks = s, _load(s.path)
        self.bytes = {i: t for t, i in self.ranks.items()}
        self.fast = tiktoken.Encoding("ranks", pat_str=s.pattern, mergeable_ranks=self.ranks, special_tokens={})
        # tiktoken cuts at the same places (tests compare all code points), but its engine overflows on long runs
        self.cut = regex.compile(s.pattern)

    def __missing__(self, token: str) -> bytes:
        ids = ids_bytes(np.array(self.fast._encode_single_piece(token), np.uint32))
        if len(token) <= 32:
            if len(self) >= self.s.kept:
                self.clear()
            self[token] = ids
        return ids

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The text's pre-tokens, a list for each stretch between stitches."""
        find, s, n = self.cut.findall, self.s, len(text)
        step = s.chunk - s.overlap
        chunks = [(x, find(text[x : x + s.chunk])) for x in range(0, max(1, n - s.overlap), step)]
        now: list[str] = []  # pre-tokens of the full text from the last stitch, without those that a cut may have changed
        end = 0  # where they end
        for x, tokens in chunks:
            stop, start = min(n, x + s.chunk), x
            if stop <= end:
                continue
            if x:
                ends, i, p = {}, len(now), end
                while i and p > x:
                    ends[p] = i
                    i -= 1
                    p -= len(now[i])
                p = x
                for j, t in enumerate(tokens):
                    p += len(t)
                    if p in ends:
                        yield now[: ends[p]]
                        start, tokens = p, tokens[j + 1 :]
                        break
                    if p >= end:
                        break
                if start == x:
                    yield now
                    start = end
                    while True:
                        tokens = find(text[start:stop])
                        if stop == n or len(tokens) > 2:
                            break
                        stop = min(n, start + 2 * (stop - start))
            # the last two before a cut may go on beyond it
            if stop == n:
                now, end = tokens, n
            elif len(tokens) > 2:
                now, end = tokens[:-2], stop - len(tokens[-1]) - len(tokens[-2])
            else:
                now, end = [], start
        yield now

    def encode(self, text: str) -> bytes:
        """Packed ids of a text, or of a piece whose ends are pre-token boundaries."""
        return b"".join([b"".join(map(self.__getitem__, piece)) for piece in self.pieces(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def boundaries(self, text: str, last: bool) -> list[int]:
        """Ends of pre-tokens, but for the last two where the text is cut off. An end after white
        space is no place to cut: the pattern looks ahead there."""
        ends = [m.end() for m in self.cut.finditer(text)]
        return [e for e in (ends if last else ends[:-2]) if not text[e - 1].isspace()]


def ids_bytes(ids: np.ndarray) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return ids.astype("<u4").tobytes()


_OUT = "doc_id long, n_tokens long, ids binary, decoded binary"
_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _rows(doc_ids, texts, coder: Codec, digest: bool) -> pa.RecordBatch:
    ids = [coder.encode(t or "") for t in texts]
    return _batch(doc_ids, ids, [coder.decode(i) for i in ids], digest)


def _batch(doc_ids, ids: list[bytes], decoded: list[bytes], digest: bool) -> pa.RecordBatch:
    counts = pa.array([len(i) // 4 for i in ids], pa.int64())
    if digest:
        sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
        return pa.record_batch({"doc_id": doc_ids, "n_tokens": counts, "ids_sha256": sha(ids), "decoded_sha256": sha(decoded)})
    return pa.record_batch({"doc_id": doc_ids, "n_tokens": counts, "ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.binary())})


def encode(docs: DataFrame, s: Settings, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens and ids and decoded (binary), or the SHA-256 of both.

    Only texts of over s.task bytes are shuffled, a chunk a row.
    """
    prepare(docs.sparkSession)
    rows = docs.select(integral(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def direct(batches):
        coder = codec(s)
        for b in batches:
            yield _rows(b.column("doc_id"), b.column("text").to_pylist(), coder, digest)

    shape = _DIGEST if digest else _OUT
    short = rows.where(F.col("text").isNull() | (F.octet_length("text") <= s.task)).mapInArrow(direct, shape)
    pieces = _pieces(rows.where(F.octet_length("text") > s.task), s)

    def code(batches):
        coder = codec(s)
        for b in batches:
            ids = [coder.encode(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "row": b.column("row"), "piece": b.column("piece"), "copies": b.column("copies"),
                "ids": pa.array(ids, pa.binary()), "decoded": pa.array([coder.decode(i) for i in ids], pa.binary()),
            })

    coded = pieces.mapInArrow(code, "doc_id long, row long, piece int, copies long, ids binary, decoded binary")
    # a group is one text of the input, so no larger than a row that was read
    joined = coded.groupBy("doc_id", "row").agg(F.max("copies").alias("copies"), F.array_sort(F.collect_list(F.struct("piece", "ids", "decoded"))).alias("p"))
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", "p")

    def gather(batches):
        for b in batches:
            p = b.column("p").to_pylist()
            yield _batch(b.column("doc_id"), [b"".join(x["ids"] for x in q) for q in p], [b"".join(x["decoded"] for x in q) for q in p], digest)

    long = joined.mapInArrow(gather, shape)
    return short.unionByName(long)


def _pieces(rows: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, row, piece, text) of long texts, cut where chunks' boundaries agree."""
    step = s.far - s.far_overlap

    def chop(batches):
        for b in batches:
            for i, key, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "row", "text"))):
                starts = range(0, max(1, len(text) - s.far_overlap), step)
                n = len(starts)
                yield pa.record_batch({
                    "doc_id": pa.array([i] * n, pa.int64()), "row": pa.array([key] * n, pa.int64()), "chunk": pa.array(range(n), pa.int32()),
                    "last": pa.array([x + s.far >= len(text) for x in starts]), "text": pa.array([text[x : x + s.far] for x in starts], pa.string()),
                })

    chunks = rows.withColumn("row", F.xxhash64("text")).mapInArrow(chop, "doc_id long, row long, chunk int, last boolean, text string")
    # deals the chunks out; rows that repeat are coded once and counted
    chunks = chunks.groupBy("doc_id", "row", "chunk").agg(F.first("last").alias("last"), F.first("text").alias("text"), F.count("*").alias("copies"))

    def cut(batches):
        coder = codec(s)
        for b in batches:
            head, tail = [], []
            for n, last, text in zip(b.column("chunk").to_pylist(), b.column("last").to_pylist(), b.column("text").to_pylist()):
                ends = coder.boundaries(text, last)
                head.append([e for e in ends if e <= s.far_overlap] if n else [0])
                tail.append([] if last else [e - step for e in ends[3:] if e >= step])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], [*b.schema.names, "head", "tail"])

    shape = "doc_id long, row long, chunk int, last boolean, text string, copies long, head array<int>, tail array<int>"
    seen = chunks.mapInArrow(cut, shape)
    order = Window.partitionBy("doc_id", "row").orderBy("chunk")
    seen = seen.withColumn("start", F.when(F.col("chunk") == 0, 0).otherwise(F.try_element_at(F.array_sort(F.array_intersect("head", F.lag("tail").over(order))), F.lit(1))))
    seen = seen.withColumn("stop", F.when(F.col("last"), F.char_length("text")).otherwise(F.lead("start").over(order) + step))
    # without a stitch the chunk's own part ends where the next begins, and both belong to one piece
    part = seen.select("doc_id", "row", "chunk", "copies", F.col("start").isNotNull().alias("begins"), F.substring(F.col("text"), F.coalesce("start", F.lit(0)) + 1, F.coalesce("stop", F.lit(step)) - F.coalesce("start", F.lit(0))).alias("text"))
    part = part.withColumn("piece", F.sum(F.col("begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return part.groupBy("doc_id", "row", "piece").agg(F.max("copies").alias("copies"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda x: x.text), "").alias("text")).repartition("doc_id", "row", "piece")


def decode(tokens: DataFrame, s: Settings, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes of its ids (little-endian unsigned 32-bit)."""
    prepare(tokens.sparkSession)

    def run(batches):
        coder = codec(s)
        for b in batches:
            yield pa.record_batch({"doc_id": b.column("doc_id"), "decoded": pa.array([coder.decode(x or b"") for x in b.column("ids").to_pylist()], pa.binary())})

    return tokens.select(integral(tokens, id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, decoded binary")
