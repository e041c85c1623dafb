"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

An item's windows are its runs of ``window`` words (an item of fewer words, but not none, is one window). A window is a
set of shingles, its runs of ``shingle`` words (a window of fewer words is one shingle). Shingles are ordered by rarity
over all documents; for exact containment the necessary prefix of a window is its rarest shingle alone. Windows are
indexed under it with the shingle's place in the window, so an occurrence in a document proposes one start per place; a
start passes the positional and length bounds if the whole window fits into the document there, and is then verified
byte by byte over the item-sized window. Documents are read once to count the items' shingles and once to probe.

The benchmark is taken in blocks of bounded size. A block's index is a few arrays (about seven bytes a byte of item
text) that every worker holds while that block's pass runs; with more blocks, each has a pass of its own, written to
the shared folder before the next begins, so no worker ever holds two. Documents are not shuffled.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. A null or empty text has no words, and
an empty table of documents or items gives no rows or no hits. Ids of documents are integers or null. Items with a null
id are named by the empty string; items with equal ids count once. A row of docs is judged on its own, so repeated rows
get equal results, and other columns of docs, whatever their names, are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, free_names, integral, prepare
from .packing import U, planes, unplanes
from .words import hash_runs, hash_words

#: Letters and digits stay, A-Z become lower case, other ASCII becomes a space, bytes of non-ASCII characters stay.
_MAP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Settings:
    window: int = 8
    shingle: int = 5  #: words of a shingle
    least_items: int = 2  #: contamination(): a document with windows of so many items is contaminated
    clean_items: int = 1  #: clean(): a document with full windows of so many items goes
    block_bytes: int = 8 << 20  #: item text taken at a time


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_MAP).split()


def _hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, the number of words of each, and where each text's words begin."""
    (words,), counts = hash_words([(t or b"").translate(_MAP) for t in texts])
    return words, counts, np.cumsum(counts) - counts


def _shingles(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in all words) at which n words of one text begin, and their hashes."""
    doc = np.repeat(np.arange(len(counts)), counts)
    h = hash_runs(words, n)
    at = np.flatnonzero(doc[: len(h)] == doc[n - 1 :][: len(h)])
    return at, h[at]


class Lookup:
    """Sorted 64-bit values; most values that are not there are told by their first 16 bits."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(values >> U(48)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in h of known values, and their places among the values (the first of equal ones)."""
        if not len(self.values):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.seen[(h >> U(48)).astype(np.int64)])
        place = np.searchsorted(self.values, h[at])
        hit = self.values[np.minimum(place, len(self.values) - 1)] == h[at]
        return at[hit], place[hit]


class Windows:
    """The windows of a block's items: distinct ones with their shingles, and the items that have each."""

    def __init__(self, items: list[tuple[str, bytes]], s: Settings):
        self.s, self.names = s, [name for name, _ in items]
        split = [words_of(t) for _, t in items]
        self.text = b"".join(w + b" " for words in split for w in words)
        size = np.array([len(w) + 1 for words in split for w in words], np.int64)
        edge = np.concatenate(([0], np.cumsum(size)))
        counts = np.array([len(w) for w in split], np.int64)
        first = np.cumsum(counts) - counts
        lanes, _ = hash_words([self.text], 2)
        starts, lengths, owner = [], [], []
        for i, n in enumerate(counts.tolist()):
            if n:
                k = max(1, n - s.window + 1)
                starts.append(first[i] + np.arange(k))
                lengths.append(np.full(k, min(n, s.window)))
                owner.append(np.full(k, i))
        start, length, item = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, lengths, owner))
        # equal windows are one: told by 128 bits of hash and by length
        ids = np.empty((len(start), 3), U)
        ids[:, 2] = length
        for n in np.unique(length).tolist():
            mine = length == n
            for lane in (0, 1):
                ids[mine, lane] = hash_runs(lanes[lane], n, lane)[start[mine]]
        _, rep, of = np.unique(ids, axis=0, return_index=True, return_inverse=True)
        self.start, self.length = start[rep], length[rep]
        self.begin, self.end = edge[self.start].astype(np.uint32), (edge[self.start + self.length] - 1).astype(np.uint32)
        pair = np.unique(np.stack((of.reshape(-1), item), 1), axis=0) if len(start) else np.empty((0, 2), np.int64)
        self.item = pair[:, 1].astype(np.int32)
        self.items_at = np.searchsorted(pair[:, 0], np.arange(len(rep) + 1)).astype(np.int32)
        #: by the words of a shingle: (window, place of the shingle in it, hash) of all shingles
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({min(int(k), s.shingle) for k in np.unique(self.length)}):
            mine = np.flatnonzero(np.minimum(self.length, s.shingle) == n)
            h = hash_runs(lanes[0], n)
            many = self.length[mine] - n + 1
            window = np.repeat(mine, many)
            place = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
            self.parts[n] = window, place, h[self.start[window] + place]

    def values(self) -> dict[int, np.ndarray]:
        return {n: np.unique(h) for n, (_, _, h) in self.parts.items()}


class Index:
    """Windows under their rarest shingle, as sorted arrays."""

    def __init__(self, w: Windows, counts: dict[int, np.ndarray]):
        self.s, self.text, self.names, self.length = w.s, w.text, w.names, w.length.astype(np.uint8)
        self.begin, self.end, self.item, self.items_at = w.begin, w.end, w.item, w.items_at
        self.by: dict[int, tuple[Lookup, np.ndarray, np.ndarray]] = {}
        for n, (window, place, h) in w.parts.items():
            rarity = counts[n][np.searchsorted(w.values()[n], h)]
            order = np.lexsort((place, h, rarity, window))
            least = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
            least = least[np.argsort(h[least], kind="stable")]
            self.by[n] = Lookup(h[least]), window[least].astype(np.int32), place[least].astype(np.uint8)

    def probe(self, texts: list[bytes | None]) -> tuple[np.ndarray, dict[int, tuple[list, set, set]]]:
        """The number of words of each text; and for those with hits: merged spans of words inside windows, the items
        hit, and those hit by full windows."""
        words, counts, first = _hashed(texts)
        starts: dict[int, list[tuple[int, int]]] = {}
        for n, (known, window, place) in self.by.items():
            at, h = _shingles(words, counts, n)
            hit, where = known.find(h)
            stop = np.searchsorted(known.values, h[hit], side="right")
            docs = np.searchsorted(first, at[hit], side="right") - 1  # the last of equal starts is the one with words
            for d, p, a, b in zip(docs.tolist(), (at[hit] - first[docs]).tolist(), where.tolist(), stop.tolist()):
                starts.setdefault(d, []).extend((p - int(place[i]), int(window[i])) for i in range(a, b))
        out = {}
        for d, found in starts.items():
            own, spans, some, full = words_of(texts[d]), [], set(), set()
            for p, w in found:
                n = int(self.length[w])
                if p >= 0 and p + n <= len(own) and b" ".join(own[p : p + n]) == self.text[self.begin[w] : self.end[w]]:
                    spans.append((p, p + n))
                    names = [self.names[i] for i in self.item[self.items_at[w] : self.items_at[w + 1]].tolist()]
                    some.update(names)
                    if n == self.s.window:
                        full.update(names)
            if spans:
                out[d] = merge(spans), some, full
        return counts, out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, s: Settings, item_col: str, item_text: str) -> list[DataFrame]:
    """Blocks of about block_bytes of item text, the number found from the summed size."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    n = max(1, -(-size // s.block_bytes))
    if n == 1:
        return [items]
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(part == i) for i in range(n)]


def _counts(docs: DataFrame, known: dict[int, np.ndarray], text_col: str, width: int = 1 << 16) -> dict[int, np.ndarray]:
    """Occurrences of the known shingles in all documents. Tasks pass on packed slices of their counts, and the driver
    gets one number for each shingle of the block."""
    look = {n: Lookup(v) for n, v in known.items()}

    def slices(total):
        rows = [(n, i, planes(c[i * width : (i + 1) * width])) for n, c in total.items() for i in range(-(-len(c) // width)) if c[i * width : (i + 1) * width].any()]
        n, i, blob = zip(*rows) if rows else ((), (), ())
        return pa.record_batch({"words": pa.array(n, pa.int32()), "slice": pa.array(i, pa.int32()), "counts": pa.array(blob, pa.binary())})

    def count(batches):
        total = {n: np.zeros(len(x.values), np.int64) for n, x in look.items()}
        for b in batches:
            words, counts, _ = _hashed(b.column("text").cast(pa.binary()).to_pylist())
            for n, x in look.items():
                np.add.at(total[n], x.find(_shingles(words, counts, n)[1])[1], 1)
        yield slices(total)

    def add(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for n, i, blob in zip(*(b.column(c).to_pylist() for c in ("words", "slice", "counts"))):
                total[n, i] = total.get((n, i), 0) + unplanes(blob, np.int64)
        for (n, i), c in total.items():
            yield pa.record_batch({"words": pa.array([n], pa.int32()), "slice": pa.array([i], pa.int32()), "counts": pa.array([c.tobytes()], pa.binary())})

    shape = "words int, slice int, counts binary"
    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, shape).repartition(8, "words", "slice").mapInArrow(add, shape).collect()
    out = {n: np.zeros(len(v), np.int64) for n, v in known.items()}
    for r in rows:
        c = np.frombuffer(r.counts, np.int64)
        out[r.words][r.slice * width : r.slice * width + len(c)] = c
    return out


def indexes(docs: DataFrame, benchmark: DataFrame, s: Settings, text_col: str, item_col: str, item_text: str):
    """The index of each block in turn; the driver holds one at a time."""
    for block in _blocks(benchmark, s, item_col, item_text):
        windows = Windows([(r.item, r.text.encode()) for r in block.collect()], s)  # block_bytes at most
        known = windows.values()
        yield Index(windows, _counts(docs, known, text_col) if known else {})


_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _probe(docs: DataFrame, index: Index, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for b in batches:
            counts, found = index.probe(b.column("text").cast(pa.binary()).to_pylist())
            hit = [found.get(i, ((), (), ())) for i in range(b.num_rows)]
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "key": b.column("key"), "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array([[{"a": a, "b": z} for a, z in f[0]] for f in hit], _SPANS), "items": pa.array([sorted(f[1]) for f in hit], pa.list_(pa.string())),
            })

    rows = docs.select(integral(docs, id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, n_words long, spans array<struct<a: long, b: long>>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, spans (of words), items (sorted ids), contaminated."""
    prepare(docs.sparkSession)
    found = []
    blocks = _blocks(benchmark, s, item_col, item_text)
    for index in indexes(docs, benchmark, s, text_col, item_col, item_text):
        one = _probe(docs, index, id_col, text_col)
        found.append(one if len(blocks) == 1 else Table(one, "contaminated").df)
    out = found[0] if len(found) == 1 else _join(found)
    return out.select(
        "doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda t, x: t + x.b - x.a).alias("n_hit"), F.size("items").cast("long").alias("n_items"), "spans", "items",
        (F.size("items") >= s.least_items).alias("contaminated"),
    )


def _join(found: list[DataFrame]) -> DataFrame:
    """Results of several blocks as one. Rows that repeat an id and a text keep their number."""
    tagged = found[0].withColumn("block", F.lit(0))
    for i, f in enumerate(found[1:], 1):
        tagged = tagged.unionByName(f.withColumn("block", F.lit(i)))

    @F.udf("array<struct<a: long, b: long>>")
    def merged(spans):
        return merge([(x.a, x.b) for x in spans])

    by = tagged.groupBy("key", "doc_id", "n_words").agg(
        F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.count_if(F.col("block") == 0).alias("copies")
    )
    return by.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).withColumn("spans", merged("spans"))


def clean(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the rows that hold a full window of ``clean_items`` items or more; one item is enough by default, as
    a leaked passage comes from one. An item shorter than a window is too weak a sign to take a document away. Rows keep
    all their columns, and nothing is shuffled. With several blocks, a text's items are gathered over the blocks.
    """
    prepare(docs.sparkSession)
    (held,) = free_names(docs, 1)
    blocks = len(_blocks(benchmark, s, item_col, item_text))
    out = docs.withColumn(held, F.array().cast("array<string>"))
    for index in indexes(docs, benchmark, s, text_col, item_col, item_text):
        out = out.withColumn(held, F.array_union(held, _full_items(index)(F.col(text_col).cast("string"))))
        out = out if blocks == 1 else Table(out, "decontaminated").df
    return out.where(F.size(held) < s.clean_items).drop(held)


def _full_items(index: Index):
    @F.pandas_udf("array<string>")
    def hit(texts: pd.Series) -> pd.Series:
        _, found = index.probe([t.encode() if t else b"" for t in texts])
        return pd.Series([sorted(found[i][2]) if i in found else [] for i in range(len(texts))])

    return hit
