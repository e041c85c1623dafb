"""SimHash near-duplicates: deletion-variant signatures.

A fingerprint has 64 bits. With at most ``distance`` differing bits and ``distance // 2 + 1`` segments, one segment
differs by at most one bit. Each segment is indexed under all its variants with one bit left out, and fingerprints
that share a variant are verified. Work is on distinct fingerprints, so copies cost nothing; a variant's group that
is large is cut again by the same rule on the other bits, so no group is compared pair by pair beyond a fixed size,
and each group passes on only a spanning forest of its links. Links become components on the cluster.

Words are runs without space, tab or line ends; A-Z are lower-cased; shingles of ``shingle`` words joined by a space,
repeats counted; a shorter text is one shingle, and one without words (null and empty texts too) has fingerprint 0,
which links like any other. Rows with equal ids each keep their fingerprint; a null id is below all others, and ids are
integers. An empty table gives no rows; other columns are kept or not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, Table, free_names, key_of, prepare
from .components import components
from .packing import U, mix, planes, roots, runs, unplanes


@dataclass(frozen=True)
class Settings:
    shingle: int = 3
    distance: int = 3
    seed: int = 42
    small: int = 2048  #: a group of more distinct fingerprints is cut again
    bucket: int = 1 << 17  #: distinct fingerprints for each bucket of a variant
    part: int = 32 << 20  #: bytes of variants for each partition
    piece: int = 1 << 16  #: shingles whose bits are counted at a time


def fingerprint(text: bytes | None, s: Settings = Settings()) -> int:
    """Bit i is set if it is in over half of the shingles' XXH64."""
    words = (text or b"").lower().split()  # bytes.lower: A-Z only; bytes.split: exactly \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - s.shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(s.shingle, len(words)) - 1 :] - 1).tolist()
    h, seed, ones = xxhash.xxh64_intdigest, s.seed, np.zeros(64, np.int64)
    for at in range(0, n, s.piece):
        part = np.fromiter((h(joined[a:b], seed) for a, b in zip(starts[at : at + s.piece], stops[at : at + s.piece])), U)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k long, h long, fp long): the key of each row, a hash of its text, and its fingerprint as a signed integer."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t, s) for t in texts), U, len(texts)).view(np.int64)
            yield pa.record_batch({"k": b.column("k"), "h": b.column("h"), "fp": pa.array(fps)})

    return docs.select(key_of(docs, id_col).alias("k"), F.xxhash64(F.col(text_col).cast("string")).alias("h"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "k long, h long, fp long")


def segments(width: int, distance: int) -> list[tuple[int, int]]:
    """(low bit, bits) of distance // 2 + 1 segments of nearly equal width."""
    m = distance // 2 + 1
    cuts = [i * width // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def compress(v: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of v, packed."""
    out = np.zeros(len(v), U)
    for i, b in enumerate(bits):
        out |= ((v >> U(b)) & U(1)) << U(i)
    return out


def forest(fps: np.ndarray, free: list[int], s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of distinct fps that agree on all bits but the free ones."""
    if len(fps) < 2:
        return []
    if len(fps) <= s.small or len(free) <= 8:
        a, b = [], []
        for i in range(0, len(fps), 256):
            near = np.bitwise_count(fps[i : i + 256, None] ^ fps[None, :]) <= s.distance
            x, y = np.nonzero(near)
            keep = x + i < y
            a.append(x[keep] + i)
            b.append(y[keep])
        a, b = np.concatenate(a), np.concatenate(b)
        root = roots(len(fps), a, b)
        moved = np.flatnonzero(root != np.arange(len(fps)))
        return [(fps[moved], fps[root[moved]])] if len(moved) else []
    links = []
    for low, bits in segments(len(free), s.distance):
        part = free[low : low + bits]
        for gone in part:
            mask = U(sum(1 << b for b in part if b != gone))
            rest = [b for b in free if b not in part or b == gone]
            order = np.argsort(fps & mask, kind="stable")
            start, size = runs((fps & mask)[order])
            for at, n in zip(start[size > 1].tolist(), size[size > 1].tolist()):
                links += forest(fps[order[at : at + n]], rest, s)
    return _fewer(links)


def _fewer(links: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same components with as few links as nodes."""
    if not links:
        return []
    a, b = (np.concatenate([x[i] for x in links]) for i in (0, 1))
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = roots(len(nodes), at[: len(a)], at[len(a) :])
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return [(nodes[moved], nodes[root[moved]])]


def links(fps: DataFrame, s: Settings = Settings()) -> DataFrame:
    """fps: distinct (fp long). Returns (a long, b long): links that connect all within the distance of each other."""
    prepare(fps.sparkSession)
    n = fps.count()
    buckets, tasks = max(32, -(-n // s.bucket)), max(16, -(-n * 8 * 64 // s.part))
    parts = [(k, low + i, U(((1 << bits) - 1) << low & ~(1 << (low + i)))) for k, (low, bits) in enumerate(segments(64, s.distance)) for i in range(bits)]

    def variants(batches):
        held, size = [], 0

        def flush():
            v = np.unique(np.concatenate(held))
            for n, (_, bit, mask) in enumerate(parts):
                where = (mix((v & mask) + U(n)) % U(buckets)).astype(int)
                order = np.argsort(where, kind="stable")
                cut = np.searchsorted(where[order], np.arange(buckets + 1))
                for j in range(buckets):
                    if cut[j] < cut[j + 1]:
                        yield n, j, planes(v[order[cut[j] : cut[j + 1]]])

        def batch(rows):
            n, j, blob = zip(*rows)
            return pa.record_batch({"variant": pa.array(n, pa.int32()), "bucket": pa.array(j, pa.int32()), "fps": pa.array(blob, pa.binary())})

        for b in batches:
            held.append(b.column("fp").to_numpy(zero_copy_only=False).view(U))
            size += len(held[-1])
            if size > max(1 << 19, 1024 * buckets):  # so that blocks hold many fingerprints
                yield batch(flush())
                held, size = [], 0
        if size:
            yield batch(flush())

    def verify(batches):
        groups: list = []

        def done(n, blobs):
            bit, mask, low_high = parts[n][1], parts[n][2], parts[n][0]
            v = np.unique(np.concatenate([unplanes(x, U) for x in blobs]))
            order = np.argsort(v & mask, kind="stable")
            v = v[order]
            start, size = runs(v & mask)
            low, bits = segments(64, s.distance)[low_high]
            free = [b for b in range(64) if b == bit or not low <= b < low + bits]
            pair = start[size == 2]
            near = pair[np.bitwise_count(v[pair] ^ v[pair + 1]) <= s.distance]
            out = [(v[near], v[near + 1])]
            for at, k in zip(start[size > 2].tolist(), size[size > 2].tolist()):
                out += forest(np.sort(v[at : at + k]), free, s)
            a, b = (np.concatenate([x[i] for x in out]).view(np.int64) for i in (0, 1))
            return pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

        last, blobs = None, []
        for b in batches:
            for n, j, blob in zip(*(b.column(c).to_pylist() for c in ("variant", "bucket", "fps"))):
                if (n, j) != last:
                    if blobs:
                        yield done(last[0], blobs)
                    last, blobs = (n, j), []
                blobs.append(blob)
        if blobs:
            yield done(last[0], blobs)

    dealt = fps.select("fp").mapInArrow(variants, "variant int, bucket int, fps binary").repartition(tasks, "variant", "bucket").sortWithinPartitions("variant", "bucket")
    return dealt.mapInArrow(verify, "a long, b long").distinct()


def _classes(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(k, h, fp, c, ch) of each row: fingerprints(), and the smallest key of its component with that key's smallest
    text hash. Also the table of fingerprints()."""
    table = Table(fingerprints(docs, s, id_col, text_col), "fingerprints").df
    first = table.groupBy("fp").agg(F.min(F.struct("k", "h")).alias("k"))
    root = Table(components(links(first.select("fp"), s)), "roots").df
    named = first.join(root, first.fp == root.node, "left").select("fp", "k", F.coalesce("root", "fp").alias("root"))
    least = named.where("root <> fp").unionByName(named.join(root.select("root").distinct(), "root", "left_semi")).groupBy("root").agg(F.min("k").alias("c"))
    owner = Table(named.join(least.distinct(), "root", "left").select(F.col("fp").alias("f"), F.coalesce("c", "k").alias("c")), "owners").df
    return table.join(owner, F.col("fp") == F.col("f")).select("k", "h", "fp", F.col("c.k").alias("c"), F.col("c.h").alias("ch")), table


def near_duplicates(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id)."""
    null = F.lit(NULL_ID)
    return _classes(docs, s, id_col, text_col)[0].select(F.nullif("k", null).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.nullif("c", null).alias("component_id"))


def one_of_each(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: of its smallest id, the smallest hash of a text, and the smallest of the rows
    that repeat both. Rows that repeat an id with other texts are judged apart."""
    k, h, row = free_names(docs, 3)
    classes, table = _classes(docs, s, id_col, text_col)
    named, same = [F.col("k").alias(k), F.col("h").alias(h)], [k, h]
    keyed = docs.withColumns({k: key_of(docs, id_col), h: F.xxhash64(F.col(text_col).cast("string"))})
    gone = classes.where("k <> c or h <> ch").select(*named).distinct()
    kept = keyed.join(gone, same, "left_anti")
    repeats = Table(table.groupBy("k", "h").agg(F.count("*").alias("n")).where("n > 1").select(*named), "repeats")
    if repeats.df.isEmpty():
        repeats.drop()
        return kept.select(*_plain(docs))
    whole = F.struct(*_plain(docs))
    one = kept.join(repeats.df, same, "left_semi").groupBy(*same).agg(F.min_by(whole, F.to_json(whole)).alias(row))
    return kept.join(repeats.df, same, "left_anti").select(*_plain(docs)).unionByName(one.select(f"{row}.*"))


def _plain(docs: DataFrame) -> list:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
