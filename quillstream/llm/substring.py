"""Substring dedup by fixed-block anchors.

Words covered by a window of ``window`` words whose sequence also starts earlier (in a smaller doc_id, or before in
the same document) are removed. Windows are judged on the input.

A window holds a whole reference block: the blocks are the non-overlapping runs of ``window // 2`` words from each
document's start. They are indexed by hash and probed with every rolling run of that length of every document; a
window can only repeat if all blocks inside it are hit. So hits are extended to windows over hit blocks alone, and
these are compared by 96 bits of hash (two lanes, from word hashes that are independent of each other and, for words
of under 8 bytes, free of collisions) to find each sequence's first start, which leaves maximal exact repeats.

Nothing pairs documents: a probe's answer is whether a run occurs twice, and a sequence's is its first start, so a
passage in any number of documents costs one entry for each stretch of text that a task reads. What repeats inside a
stretch is settled there and never travels, so a line of every document is no hot key. Entries travel as packed
blocks, dealt by hash. With more buckets than ``fan``, they are dealt in levels: a level gathers the entries of many
stretches, settles what repeats among them, and deals the rest on, so that blocks stay large and buckets have no
ceiling. Texts are shuffled once, by their own hash, into partitions whose number follows from the input's size.

A null text has no words; an empty table gives no rows. Ids are integers or null; a null id is below all others. Rows
that repeat an id: only a smaller id or start removes words, so full copies of a row get equal results (a stretch
takes them once, with their number), and different texts under one id are judged apart. A text is known by its id and
96 bits of hash all through, so what is found for it never grows with the rows of its id. Only texts of one id that
also have the same window at the same place are told of it one by one. Other columns of docs are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, Table, buckets_for, key_of, prepare
from .packing import U, mix, pack_sorted, planes, unpack_sorted, unplanes
from .words import hash_runs, hash_words


@dataclass(frozen=True)
class Settings:
    window: int = 20
    stretch: int = 6 << 20  #: bytes of text whose runs are settled together in a task
    bucket_bytes: int = 8 << 20  #: input bytes for each bucket of the index
    text_bytes: int = 16 << 20  #: input bytes for each partition of texts
    fan: int = 1024  #: a level of dealing has so many blocks for each stretch, at most
    entries: int = 1 << 20  #: entries of many stretches that a level settles together

    @property
    def block(self) -> int:
        return self.window // 2


#: A text: its id and two hashes.
_TEXT = ("k", "tag", "mark")


def _combine(batches):
    """Rows that repeat an id and a text within a batch are one, with their number."""
    for b in batches:
        seen: dict[tuple, int] = {}
        at, copies = [], []
        for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in _TEXT))):
            if key in seen:
                copies[seen[key]] += 1
            else:
                seen[key] = len(at)
                at.append(i)
                copies.append(1)
        kept = b if len(at) == b.num_rows else b.take(pa.array(at))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(copies, pa.int64())], [*b.schema.names, "copies"])


def _stretches(batches, columns: tuple[str, ...], size: int):
    """Columns of whole rows, about size bytes of text at a time. Rows that repeat an id and a text count once."""
    held, total, seen = [[] for _ in columns], 0, set()
    for b in batches:
        lists = [b.column(c).cast(pa.binary()).to_pylist() if c == "text" else b.column(c).to_pylist() for c in columns]
        for row in zip(*lists):
            if row[:3] in seen:
                continue
            seen.add(row[:3])
            for h, v in zip(held, row):
                h.append(v)
            total += len(row[columns.index("text")] or b"") + 1
            if total >= size:
                yield held
                held, total, seen = [[] for _ in columns], 0, set()
    if held[0]:
        yield held


Entries = dict[str, np.ndarray]


def _cat(parts: list[Entries]) -> Entries:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


class _Kind:
    """A kind of entry: sorted by a first hash, dealt by it, settled where entries meet."""

    key: str  #: the hash
    found: tuple[tuple[str, type], ...]  #: columns of what is found
    shape: str

    def pack(self, e: Entries, part: slice = slice(None)) -> list[bytes]: ...
    def unpack(self, blobs: list[bytes]) -> Entries: ...
    def cat(self, parts: list[Entries]) -> Entries:
        return _cat(parts)

    def settle(self, e: Entries) -> tuple[Entries, Entries]:
        """(entries that others may still change, what is found), the former sorted."""


class _Blocks(_Kind):
    """A hash of a run of words, its state (0: once, 1: once, as a reference block, 2: more often), and for state 1 the
    place of its block among the blocks' columns. Found: blocks whose run occurs more than once.

    A chance hit only makes a window a candidate, so hashes have no more bits than that many buckets ask for.
    """

    key = "value"
    found = (("k", np.int64), ("tag", np.int64), ("mark", np.int32), ("block", np.uint32))

    def __init__(self, buckets: int):
        self.drop = U(max(0, 64 - (40 + buckets.bit_length())))

    def pack(self, e, part=slice(None)):
        own = e["ref"][part][e["state"][part] == 1]
        return [pack_sorted(e["value"][part] >> self.drop), planes(e["state"][part]), *(planes(e[c][own]) for c, _ in self.found)]

    def unpack(self, blobs):
        e = {"value": unpack_sorted(blobs[0]) << self.drop, "state": unplanes(blobs[1], np.uint8)}
        e["ref"] = (np.cumsum(e["state"] == 1) - 1).astype(np.int32)
        return e | {c: unplanes(x, kind) for (c, kind), x in zip(self.found, blobs[2:])}

    def cat(self, parts):
        e = _cat(parts)
        first = np.cumsum([0, *(len(p["k"]) for p in parts[:-1])])
        e["ref"] += np.repeat(first, [len(p["ref"]) for p in parts]).astype(np.int32)
        return e

    def settle(self, e):
        order = np.argsort(e["value"])
        value, state = e["value"][order], e["state"][order]
        head = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.empty(0, np.int64)
        size = np.diff(np.append(head, len(value)))
        many = (size > 1) | (np.maximum.reduceat(state, head) > 1 if len(head) else False)
        hit = e["ref"][order[np.repeat(many, size) & (state == 1)]]
        columns = {c: e[c] for c, _ in self.found}
        left = {"value": value[head], "state": np.where(many, 2, state[head]).astype(np.uint8), "ref": e["ref"][order[head]]}
        return left | columns, {c: v[hit] for c, v in columns.items()}


class _Windows(_Kind):
    """A window: two hashes of its words (64 and 32 bits), its text and start. Found: starts of windows whose sequence
    starts earlier."""

    key = "a"
    found = (("k", np.int64), ("tag", np.int64), ("mark", np.int32), ("pos", np.uint32))

    def pack(self, e, part=slice(None)):
        return [pack_sorted(e["a"][part]), planes(e["b"][part]), *(planes(e[c][part]) for c, _ in self.found)]

    def unpack(self, blobs):
        return {"a": unpack_sorted(blobs[0]), "b": unplanes(blobs[1], np.uint32)} | {c: unplanes(x, kind) for (c, kind), x in zip(self.found, blobs[2:])}

    def settle(self, e):
        order = np.lexsort((e["pos"], e["k"], e["b"], e["a"]))
        a, b, k, pos = (e[c][order] for c in ("a", "b", "k", "pos"))
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.empty(0, bool)
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (k != k[first]) | (pos != pos[first])
        return {c: v[order[~later]] for c, v in e.items()}, {c: e[c][order[later]] for c, _ in self.found}


_SHAPE = "bucket long, salt int, b0 binary, b1 binary, b2 binary, b3 binary, b4 binary, b5 binary"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (bucket, salt, blobs); what is found has four blobs and a negative bucket."""
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
    names = ["bucket", "salt", *(f"b{i}" for i in range(6))]
    full = [(*r[:2], *r[2], *[None] * (6 - len(r[2]))) for r in rows]
    return pa.record_batch({n: pa.array([r[i] for r in full], k) for i, (n, k) in enumerate(zip(names, kinds))})


def _place(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a hash, in the hashes' order."""
    return ((hashes >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _spread(found: Entries, parts: int):
    """What is found, dealt by its text."""
    part = (mix(found["k"].view(U) ^ found["tag"].view(U)) % U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cut = np.searchsorted(part[order], np.arange(parts + 1))
    for i in np.flatnonzero(np.diff(cut)).tolist():
        at = order[cut[i] : cut[i + 1]]
        yield -1 - i, 0, [planes(v[at]) for v in found.values()]


def _deal(kind: _Kind, left: Entries, found: Entries, buckets: int, width: int, salt: int, back: int) -> pa.RecordBatch:
    """Blocks of entries, one for each width buckets, and what is found, which passes all levels unopened."""
    place = _place(left[kind.key], buckets) // width
    cut = np.flatnonzero(np.diff(place, prepend=-1, append=-1)) if len(place) else np.empty(0, np.int64)
    rows = [(int(place[x]), salt, kind.pack(left, slice(x, y))) for x, y in zip(cut, cut[1:])]
    return _blobs(rows + (list(_spread(found, back)) if len(found["k"]) else []))


def _exchange(kind: _Kind, dealt: DataFrame, s: Settings, buckets: int, back: int) -> DataFrame:
    """From blocks of first entries to (part, b0..b3): all that is found, packed, in parts of texts.

    Levels before the last may have many tasks for a bucket; in the last each bucket is whole, in one task.
    """
    width = _width(s, buckets)
    while width > 1:
        narrow = max(1, width // s.fan)

        def level(batches, width=width, narrow=narrow):
            held, size, number = [], 0, 0
            for b in batches:
                for bucket, _, *blobs in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                    if bucket < 0:
                        yield _blobs([(bucket, 0, [x for x in blobs if x is not None])])
                        continue
                    held.append(kind.unpack(blobs))
                    size += len(held[-1][kind.key])
                    if size >= s.entries:
                        yield _deal(kind, *kind.settle(kind.cat(held)), buckets, narrow, number, back)
                        held, size, number = [], 0, number + 1
            if held:
                yield _deal(kind, *kind.settle(kind.cat(held)), buckets, narrow, number, back)

        dealt = dealt.repartition(buckets, "bucket", "salt").sortWithinPartitions("bucket").mapInArrow(level, _SHAPE)
        width = narrow

    def last(batches):
        now, held = None, []

        def done():
            _, found = kind.settle(kind.cat(held))
            if len(found["k"]):
                yield _blobs(list(_spread(found, back)))

        for b in batches:
            for bucket, _, *blobs in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                if bucket < 0:
                    yield _blobs([(bucket, 0, [x for x in blobs if x is not None])])
                    continue
                if bucket != now:
                    if held:
                        yield from done()
                    now, held = bucket, []
                held.append(kind.unpack(blobs))
        if held:
            yield from done()

    whole = dealt.repartitionById(buckets, F.pmod("bucket", F.lit(buckets)).cast("int")).sortWithinPartitions("bucket").mapInArrow(last, _SHAPE)
    return whole.select(F.col("bucket").alias("part"), "b0", "b1", "b2", "b3")


def _width(s: Settings, buckets: int) -> int:
    """Buckets to a block of the first level."""
    width = 1
    while -(-buckets // width) > s.fan:
        width *= s.fan
    return width


def _gathered(found: DataFrame, kind: _Kind, parts: int, row, shape: str) -> DataFrame:
    """A row for each text with what is found for it: row(k, tag, mark, value, first of each text)."""

    def gather(batches):
        now, held = None, []

        def done():
            e = {c: np.concatenate([unplanes(h[i], t) for h in held]) for i, (c, t) in enumerate(kind.found)}
            k, tag, mark, at = e.values()
            order = np.lexsort((at, mark, tag, k))
            k, tag, mark, at = k[order], tag[order], mark[order], at[order]
            new = np.concatenate(([True], (k[1:] != k[:-1]) | (tag[1:] != tag[:-1]) | (mark[1:] != mark[:-1])))
            return row(k, tag, mark, at, new)

        for b in batches:
            for part, *blobs in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                if part != now:
                    if held:
                        yield done()
                    now, held = part, []
                held.append(blobs)
        if held:
            yield done()

    return found.repartitionById(parts, (-1 - F.col("part")).cast("int")).sortWithinPartitions("part").mapInArrow(gather, shape)


def _keys(k, tag, mark) -> dict[str, pa.Array]:
    return {"k": pa.array(k), "tag": pa.array(tag), "mark": pa.array(mark)}


def _hit_rows(k, tag, mark, block, new) -> pa.RecordBatch:
    """The hit blocks of each text as packed ascending integers."""
    cut = np.append(np.flatnonzero(new), len(k))
    return pa.record_batch(_keys(*(x[cut[:-1]] for x in (k, tag, mark))) | {"blocks": pa.array([planes(block[x:y]) for x, y in zip(cut, cut[1:])], pa.binary())})


def _later_rows(k, tag, mark, pos, new) -> pa.RecordBatch:
    """The starts of each text as runs of consecutive ones."""
    pos = pos.astype(np.int64)
    begin = np.flatnonzero(new | np.concatenate(([True], pos[1:] > pos[:-1] + 1)))
    end = np.append(begin[1:], len(pos)) - 1
    start, length = pos[begin].astype(np.uint32), (pos[end] - pos[begin] + 1).astype(np.uint32)
    cut = np.append(np.flatnonzero(new[begin]), len(begin))
    heads = begin[cut[:-1]]
    return pa.record_batch(_keys(k[heads], tag[heads], mark[heads]) | {
        "start": pa.array([start[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary()), "runs": pa.array([length[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary()),
    })


def _hit_blocks(rows: DataFrame, s: Settings, buckets: int, parts: int) -> DataFrame:
    """rows: (k, tag, mark, text). (k, tag, mark, blocks): reference blocks whose run of words occurs more than once."""
    kind, width = _Blocks(buckets), _width(s, buckets)

    def index(batches):
        for number, (ids, tags, marks, texts) in enumerate(_stretches(batches, (*_TEXT, "text"), s.stretch)):
            (words,), counts = hash_words(texts)
            doc = np.repeat(np.arange(len(texts)), counts)
            first = np.cumsum(counts) - counts
            h = hash_runs(words, s.block)
            at = np.flatnonzero(doc[: len(h)] == doc[s.block - 1 :][: len(h)])
            if not len(at):
                continue
            own = at - first[doc[at]]
            whole = own % s.block == 0
            of = doc[at[whole]]
            e = {"value": h[at] >> kind.drop << kind.drop, "state": whole.astype(np.uint8), "ref": (np.cumsum(whole) - 1).astype(np.int32), "block": (own[whole] // s.block).astype(np.uint32)}
            e |= {c: np.array(x, t)[of] for (c, t), x in zip(kind.found, (ids, tags, marks))}
            yield _deal(kind, *kind.settle(e), buckets, width, number, parts)

    dealt = rows.select(*_TEXT, "text").mapInArrow(index, _SHAPE)
    return _gathered(_exchange(kind, dealt, s, buckets, parts), kind, parts, _hit_rows, "k long, tag long, mark int, blocks binary")


def _later_windows(rows: DataFrame, s: Settings, buckets: int, parts: int) -> DataFrame:
    """rows: (k, tag, mark, text, blocks). (k, tag, mark, start, runs): starts and run lengths of windows that are not
    the first of their sequence."""
    n, m, kind, width = s.window, s.block, _Windows(), _width(s, buckets)

    def candidates(batches):
        for number, (ids, tags, marks, texts, blocks) in enumerate(_stretches(batches, (*_TEXT, "text", "blocks"), s.stretch)):
            lanes, counts = hash_words(texts, 2)
            if len(lanes[0]) < n:
                continue
            base = np.cumsum(counts) - counts
            at = []
            for i, found in enumerate(blocks):
                if counts[i] >= n:
                    hit = np.zeros(counts[i] // m + 2, bool)
                    hit[unplanes(found, np.uint32)] = True
                    p = np.arange(counts[i] - n + 1)
                    q = -(-p // m)
                    at.append(p[hit[q] & ((p % m != 0) | hit[q + 1])] + base[i])
            at = np.concatenate(at) if at else np.empty(0, np.int64)
            if not len(at):
                continue
            # texts without words share their base with the next; the last of equal bases is the one with words
            doc = np.searchsorted(base, at, side="right") - 1
            e = {"a": hash_runs(lanes[0], n, 0)[at], "b": (hash_runs(lanes[1], n, 1)[at] >> U(32)).astype(np.uint32)}
            e |= {c: np.array(x, t)[doc] for (c, t), x in zip(kind.found, (ids, tags, marks))} | {"pos": (at - base[doc]).astype(np.uint32)}
            yield _deal(kind, *kind.settle(e), buckets, width, number, parts)

    return _gathered(_exchange(kind, rows.mapInArrow(candidates, _SHAPE), s, buckets, parts), kind, parts, _later_rows, "k long, tag long, mark int, start binary, runs binary")


def remove(text: bytes | None, start: bytes | None, runs: bytes | None, window: int) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the kept words joined by a space."""
    words = (text or b"").split()
    if start is None:
        return len(words), 0, b" ".join(words)
    start = np.frombuffer(start, np.uint32).astype(np.int64)
    stop = start + np.frombuffer(runs, np.uint32) - 1 + window
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, stop, -1)
    keep = np.cumsum(cover[:-1]) == 0
    kept = [w for w, x in zip(words, keep.tolist()) if x]
    return len(words), len(words) - len(kept), b" ".join(kept)


def dedup(docs: DataFrame, s: Settings = Settings(), digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, and kept (text) or its SHA-256, kept_sha256."""
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(key_of(docs, id_col).alias("k"), F.xxhash64(text).alias("tag"), F.hash(F.lit(1), text).alias("mark"), text.alias("text"))
    buckets, parts = buckets_for(rows, s.bucket_bytes), buckets_for(rows, s.text_bytes)
    hits = Table(_hit_blocks(rows, s, buckets, parts), "hit-blocks")
    # both uses of the dealt texts are the same exchange (an inner join asks for keys that are not null, so both do),
    # and texts are shuffled once; what is found grows with them and
    # looks smaller than it is, so it is not broadcast, at any size
    dealt = rows.mapInArrow(_combine, "k long, tag long, mark int, text string, copies long").where("k is not null and tag is not null and mark is not null").repartition(parts, *_TEXT)
    wanted = dealt.join(hits.df.repartition(parts, *_TEXT).hint("merge"), list(_TEXT)).select(*_TEXT, "text", "blocks", "copies")
    found = _later_windows(wanted, s, 2 * buckets, parts).repartition(parts, *_TEXT).hint("merge")

    def apply(batches):
        for b in batches:
            done = [remove(*row, s.window) for row in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("start").to_pylist(), b.column("runs").to_pylist())]
            copies = b.column("copies").to_pylist()
            ids = np.repeat(b.column("k").to_numpy(zero_copy_only=False), copies)
            n, gone, kept = ([x[i] for x, c in zip(done, copies) for _ in range(c)] for i in range(3))
            last = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()) if digest else pa.array([x.decode() for x in kept], pa.string())
            yield pa.record_batch({"k": pa.array(ids, pa.int64()), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept": last})

    out = dealt.join(found, list(_TEXT), "left").select("k", "text", "copies", "start", "runs").mapInArrow(apply, "k long, n_words long, n_removed long, kept string")
    return out.select(F.nullif("k", F.lit(NULL_ID)).alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256" if digest else "kept"))
