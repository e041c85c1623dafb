"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Labels are learned only from rows whose ``crc32(doc_id as text) mod folds`` is not 0. The fit uses a bounded
sample (``Settings.per_class`` rows of each class, chosen by a hash of the id); scoring covers every row and
whole texts. Null and empty texts have no n-grams and score the intercept alone. Labels, language, source and
id are no input of a score. Rows are never joined for scoring, so repeated rows and null ids score as any other, an empty table
gives no rows, and other columns are not looked at. Of labelled ids with the same hash, the smaller one is sampled first.
Without labelled rows of both classes, every score is the smoothed share of the positive class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Table, prepare


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (2, 3, 4, 5, 6)  #: n-gram lengths in characters
    bits: int = 20  #: features are hashed to 2**bits
    per_class: int = 3000  #: at most so many labelled rows of each class are learned from
    keep: int = 40_000  #: features kept for the fit, the most telling ones
    least_df: int = 3  #: a kept feature occurs in so many sampled texts at least
    alpha: float = 1.0  #: smoothing of the log-count ratios
    l2: float = 1.0
    rounds: int = 60
    folds: int = 5
    parts: int = 3  #: cross-fitting of the calibration
    piece: int = 1 << 18  #: characters hashed at a time
    block: int = 256  #: sampled texts that the fit works on at a time
    entries: int = 24 << 20  #: places of features that the fit keeps unpacked; texts beyond them are unpacked when needed


def grams(text: str, s: Settings) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of the lower-cased text, piece by piece."""
    a = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    over = max(s.orders) - 1
    for at in range(0, max(1, len(a) - over), s.piece):
        part = a[at : at + s.piece + over]
        h = part * np.uint32(0x9E3779B1)
        for n in range(1, max(s.orders) + 1):
            if n > 1:
                h = h[: max(0, len(part) - n + 1)] * np.uint32(0x85EBCA6B) + part[n - 1 :] * np.uint32(0x9E3779B1)
            if n in s.orders:
                x = h ^ np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF)
                x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                x ^= x >> np.uint32(12)
                yield (x * np.uint32(0x297A2D39)) >> np.uint32(32 - s.bits)


def present(text: str | None, s: Settings, mask: np.ndarray | None = None) -> np.ndarray:
    """The distinct features of a text, those set in mask only."""
    parts = [np.unique(g if mask is None else g[mask[g]]) for g in grams(text or "", s)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint32)


@dataclass(frozen=True)
class Model:
    settings: Settings
    features: np.ndarray  #: sorted
    weights: np.ndarray
    bias: float

    def scorer(self):
        table = np.zeros(1 << self.settings.bits, np.float32)
        table[self.features] = self.weights
        mask = table != 0
        last, place = np.zeros(1 << self.settings.bits, np.int64), np.zeros(1 << self.settings.bits, np.int32)
        number = 0

        def score(text: str | None) -> float:
            """Sums each feature of the text once: the last place that holds it, in the first piece that does."""
            nonlocal number
            number += 1
            z = self.bias
            for g in grams(text or "", self.settings):
                g = g[mask[g]]
                g = g[last[g] != number]
                at = np.arange(len(g), dtype=np.int32)
                place[g] = at
                g = g[place[g] == at]
                last[g] = number
                z += float(table[g].sum(dtype=np.float64))
            return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

        return score


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def minimise(fun, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking."""
    f, g = fun(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        q, alphas = g.copy(), []
        for ds, dg, rho in reversed(past):
            alphas.append(rho * ds.dot(q))
            q -= alphas[-1] * dg
        if past:
            q *= past[-1][0].dot(past[-1][1]) / past[-1][1].dot(past[-1][1])
        for (ds, dg, rho), a in zip(past, reversed(alphas)):
            q += ds * (a - rho * dg.dot(q))
        step, slope = 1.0 if past else 1 / max(1.0, float(np.abs(g).sum())), -g.dot(q)
        for _ in range(25):
            new = x - step * q
            nf, ng = fun(new)
            if nf <= f + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        ds, dg = new - x, ng - g
        if ds.dot(dg) > 1e-12:
            past = [*past[-memory + 1 :], (ds, dg, 1 / ds.dot(dg))]
        done = f - nf < 1e-7 * max(1.0, abs(f))
        x, f, g = new, nf, ng
        if done:
            break
    return x


def sample(docs: DataFrame, labels: DataFrame, s: Settings, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Up to per_class labelled training texts of each class: (_id, label, text). Conflicting labels of an id: the
    largest; of rows that repeat an id, one: that of the smallest text hash."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col), s.folds))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    order = [F.xxhash64("_id"), F.col("_id")]
    ids = known.where("label = 1").orderBy(*order).limit(s.per_class).unionByName(known.where("label = 0").orderBy(*order).limit(s.per_class))
    # at most 2 * per_class ids: small by construction, so the texts need no shuffle
    ids = F.broadcast(ids)
    rows = docs.select(F.col(id_col).alias("_doc"), F.struct(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).alias("row")).join(ids, F.col("_doc") == F.col("_id"))
    return rows.groupBy("_id", "label").agg(F.min("row").alias("row")).select("_id", "label", "row.text")


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns a Model. Reads the documents once for the sample; the driver gets counts and the sample's kept features."""
    spark = docs.sparkSession
    prepare(spark)
    chosen = Table(sample(docs, labels, s, id_col, text_col, label_col).repartition(24, "_id"), "toxicity-sample")
    prior = known_share(labels, s, id_col, label_col)
    width = 1 << max(0, s.bits - 6)

    def count(batches):
        total = np.zeros((2, 1 << s.bits), np.int32)
        rows = [0, 0]
        for b in batches:
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                total[label, present(text, s)] += 1
                rows[label] += 1
        if sum(rows):
            parts = range(-(-total.shape[1] // width))
            blobs = [np.ascontiguousarray(total[:, i * width : (i + 1) * width]).tobytes() for i in parts]
            yield pa.record_batch({"slice": pa.array(parts, pa.int32()), "counts": pa.array(blobs, pa.binary()), "n0": pa.array([rows[0]] * len(blobs), pa.int64()), "n1": pa.array([rows[1]] * len(blobs), pa.int64())})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        rows: dict[int, np.ndarray] = {}
        for b in batches:
            for k, blob, n0, n1 in zip(*(b.column(c).to_pylist() for c in ("slice", "counts", "n0", "n1"))):
                sums[k] = sums.get(k, 0) + np.frombuffer(blob, np.int32).astype(np.int64)
                rows[k] = rows.get(k, 0) + np.array([n0, n1])
        if sums:
            keys = sorted(sums)
            yield pa.record_batch({"slice": pa.array(keys, pa.int32()), "counts": pa.array([sums[k].tobytes() for k in keys], pa.binary()), "n0": pa.array([int(rows[k][0]) for k in keys], pa.int64()), "n1": pa.array([int(rows[k][1]) for k in keys], pa.int64())})

    shape = "slice int, counts binary, n0 long, n1 long"
    # 2**bits counts for each class: bounded by the settings
    counts = sorted(chosen.df.mapInArrow(count, shape).repartition(8, "slice").mapInArrow(add, shape).collect())
    if not counts or not (counts[0].n0 and counts[0].n1):
        chosen.drop()
        return Model(s, np.empty(0, np.uint32), np.empty(0, np.float32), float(np.log(prior / (1 - prior))))
    both = np.concatenate([np.frombuffer(r.counts, np.int64).reshape(2, -1) for r in counts], 1)
    n = np.array([counts[0].n0, counts[0].n1], float)
    df = both.sum(0)
    shares = (both + s.alpha) / (n[:, None] + 2 * s.alpha)
    ratio = np.log(shares[1] / shares[0])
    tell = np.where(df >= s.least_df, np.abs(ratio) * np.sqrt(df), 0)
    features = np.sort(np.argsort(-tell, kind="stable")[: s.keep])
    features = features[tell[features] > 0].astype(np.uint32)
    mask = np.zeros(1 << s.bits, bool)
    mask[features] = True

    def encode(batches):
        for b in batches:
            bits = [np.packbits(np.isin(features, present(t, s, mask), assume_unique=True)).tobytes() for t in b.column("text").to_pylist()]
            yield pa.record_batch({"id": b.column("_id").cast(pa.int64()), "label": b.column("label"), "found": pa.array(bits, pa.binary())})

    y, found = [], []
    # 2 * per_class rows of keep bits: 30 MB at most as set
    for r in sorted(chosen.df.mapInArrow(encode, "id long, label int, found binary").toLocalIterator()):
        y.append(float(r.label))
        found.append(np.frombuffer(r.found, np.uint8))
    chosen.drop()
    found = Sample(found, len(features), s)
    y = np.array(y)
    scale = ratio[features]
    importance = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    part = np.empty(len(y), int)
    part[np.argsort(y, kind="stable")] = np.arange(len(y)) % s.parts
    z = np.zeros(len(y))
    for k in range(s.parts):  # scores by models that have not seen the text, to calibrate on
        v = solve(found, scale, y, importance, part != k, s)
        z[part == k] = [v[:-1][found.features(i)].sum() + v[-1] for i in np.flatnonzero(part == k)]
    v = solve(found, scale, y, importance, part >= 0, s)
    slope, shift = platt(z, y, importance)
    return Model(s, features, (slope * v[:-1]).astype(np.float32), float(slope * v[-1] + shift))


class Sample:
    """The features of the sampled texts: a bit for each, and places for as many texts as fit into ``entries``."""

    def __init__(self, bits: list[np.ndarray], n: int, s: Settings):
        self.bits, self.n, self.held, left = bits, n, {}, s.entries
        for i, b in enumerate(bits):
            own = self._places(b)
            if len(own) > left:
                break
            self.held[i] = own.astype(np.uint16 if n <= 1 << 16 else np.int32)
            left -= len(own)

    def _places(self, bits: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bits, count=self.n))

    def features(self, i: int) -> np.ndarray:
        own = self.held.get(i)
        return self._places(self.bits[i]) if own is None else own


def solve(found: Sample, scale: np.ndarray, y: np.ndarray, importance: np.ndarray, use: np.ndarray, s: Settings) -> np.ndarray:
    """Regularised logistic regression on scaled features: the weight of each feature's presence, and the bias.

    Works through blocks of texts, so that beyond the sample it needs a few MB.
    """
    rows = np.flatnonzero(use)
    y, importance = y[rows], importance[rows]

    def loss(v):
        u, value, grad, bias = scale * v[:-1], 0.0, np.zeros(len(scale)), 0.0
        for at in range(0, len(rows), s.block):
            own = [found.features(i) for i in rows[at : at + s.block].tolist()]
            counts = [len(f) for f in own]
            col = np.concatenate([np.empty(0, np.uint16), *own])
            z = np.bincount(np.repeat(np.arange(len(own)), counts), u[col], len(own)) + v[-1]
            label, weight = y[at : at + s.block], importance[at : at + s.block]
            e = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - label)
            grad += np.bincount(col, np.repeat(e, counts), len(scale))
            value += (weight * (np.logaddexp(0, z) - label * z)).sum()
            bias += e.sum()
        return value + s.l2 / 2 * v[:-1].dot(v[:-1]), np.append(scale * grad + s.l2 * v[:-1], bias)

    v = minimise(loss, np.zeros(len(scale) + 1), s.rounds)
    v[:-1] *= scale
    return v


def platt(z: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores of unseen texts into log-odds."""

    def loss(v):
        t = v[0] * z + v[1]
        e = importance * (1 / (1 + np.exp(-np.clip(t, -60, 60))) - y)
        value = (importance * (np.logaddexp(0, t) - y * t)).sum() + 1e-3 * (v[0] - 1) ** 2
        return value, np.array([e.dot(z) + 2e-3 * (v[0] - 1), e.sum()])

    slope, shift = minimise(loss, np.array([1.0, 0.0]), 50)
    return float(max(slope, 1e-3)), float(shift)


def known_share(labels: DataFrame, s: Settings, id_col: str, label_col: str) -> float:
    """The smoothed share of the positive class among all labelled training rows."""
    r = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col), s.folds)).agg(F.count("*").alias("n"), F.sum((F.col(label_col) > 0).cast("long")).alias("p")).first()
    return ((r.p or 0) + 1) / (r.n + 2)


def score_column(model: Model, text: Column) -> Column:
    """The probability that a text is toxic."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per row of docs: id, held_out, score (0 to 1), predicted (1 if score >= 0.5)."""
    model = fit(docs, labels, s, id_col, text_col, label_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), s.folds).alias("held_out"), score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
