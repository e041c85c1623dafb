"""Approximate search: an inverted file of cells around centroids.

The centroids, and the number of cells that a search probes, are fitted on a bounded sample (SAMPLE_BYTES); every row is
in the index. Cells share blocks of rows, large ones are cut into several, and a query goes to the blocks of the cells that
it probes, where nearest.dealt scores it. Rows without a usable vector (null, no length, another number of dimensions, not finite) are in
cell -1, which no query probes, and queries without one find nothing. Scores and ties are those of index.search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ship import ship
from . import nearest

SAMPLE_BYTES = 64 << 20  #: of vectors that a fit brings to the driver
CELL_BYTES = 16 << 20  #: of centroids, which every worker holds
TUNED_ON = 200  #: rows of the sample whose neighbours set the number of probes


@dataclass(frozen=True)
class Cells:
    centroids: np.ndarray  #: unit length, a row a cell
    probes: int

    @property
    def dims(self) -> int:
        return self.centroids.shape[1]


def _unit(values: list, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors as rows, and which of values are usable; the others' rows are zero."""
    out, good = np.zeros((len(values), dims), np.float32), np.zeros(len(values), bool)
    for i, v in enumerate(values):
        if v is not None and len(v) == dims:
            x = np.asarray(v, np.float64)
            with np.errstate(all="ignore"):
                length = np.sqrt(x @ x)
            if np.isfinite(length) and length > 0:
                out[i], good[i] = x / length, True
    return out, good


def _means(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from spread-out rows. A cell that loses all its rows keeps its centroid."""
    at = np.random.default_rng(0).permutation(len(x))[:cells]
    c = x[at].copy()
    for _ in range(rounds):
        of = np.concatenate([np.argmax(x[i : i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, of, x)
        length = np.linalg.norm(sums, axis=1)
        c = np.where(length[:, None] > 0, sums / np.maximum(length, 1e-30)[:, None], c)
    return c.astype(np.float32)


def _probes(x: np.ndarray, c: np.ndarray, target: float, k: int = 10) -> int:
    """The fewest probes that reach target of the k nearest other rows of some rows of the sample."""
    of = np.concatenate([np.argmax(x[i : i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])
    ranks = []
    for q in range(0, len(x), max(1, len(x) // TUNED_ON)):
        near = x @ x[q]
        near[q] = -np.inf
        best = np.argsort(-near)[: min(k, len(x) - 1)]
        place = np.empty(len(c), np.int64)
        place[np.argsort(-(c @ x[q]))] = np.arange(len(c))
        ranks.extend(place[of[best]])
    return int(np.sort(ranks)[max(int(np.ceil(target * len(ranks))) - 1, 0)]) + 1 if ranks else 1


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cells: int | None = None, target: float = 0.95) -> Cells:
    """Centroids and probes from a sample by a hash of the id. cells: the square root of the rows if not given; never
    more than an eighth of the sample, or than CELL_BYTES hold."""
    usable = vectors.where(F.size(vector_col) > 0)
    seen = usable.agg(F.count("*").alias("n"), F.max(F.size(vector_col)).alias("dims")).first()
    if not seen.n:
        return Cells(np.zeros((1, 1), np.float32), 1)
    most = max(SAMPLE_BYTES // (4 * seen.dims), 64)
    drawn = usable if seen.n <= most else usable.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int((1 << 30) * 0.9 * most / seen.n))
    rows = drawn.select(vector_col).limit(most).toPandas()[vector_col]
    x, good = _unit(list(rows), seen.dims)
    x = x[good]
    if not len(x):
        return Cells(np.zeros((1, seen.dims), np.float32), 1)
    want = min(cells or int(seen.n**0.5), max(len(x) // 8, 1), max(CELL_BYTES // (4 * seen.dims), 1))
    c = _means(x, max(want, 1))
    return Cells(c, _probes(x, c, target))


def _cells_of(vector: Column, made: Cells, most: int) -> Column:
    """array<int> of the ``most`` nearest cells, nearest first; empty if the vector is not usable."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = made.centroids
        for b in batches:
            x, good = _unit(list(b), c.shape[1])
            near = x @ c.T
            top = np.argmax(near, axis=1)[:, None] if most == 1 else np.argsort(-near, axis=1, kind="stable")[:, :most]
            yield pd.Series([row if g else [] for row, g in zip(top.astype(np.int32).tolist(), good)], dtype=object)

    return run(vector)


def build(vectors: DataFrame, made: Cells, vector_col: str = "embedding") -> DataFrame:
    """vectors with their cell. Written partitioned by cell, a search reads the probed cells alone."""
    ship(vectors.sparkSession)
    return vectors.withColumn("cell", F.coalesce(F.try_element_at(_cells_of(F.col(vector_col), made, 1), F.lit(1)), F.lit(-1)))


def _layout(sizes: dict[int, int], cells: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each cell and how many it has: small cells share one, of about ``most`` rows, and large ones are cut."""
    first, parts, at, filled = np.zeros(cells, np.int32), np.ones(cells, np.int32), 0, 0
    for c in range(cells):
        n = sizes.get(c, 0)
        if filled and filled + n > most:
            at, filled = at + 1, 0
        first[c], parts[c] = at, max(-(-n // most), 1)
        at, filled = at + int(parts[c]) - 1, n if parts[c] == 1 and not filled else filled + n
    return first, parts


def _asked(vector: Column, made: Cells, probes: int, first: np.ndarray, parts: np.ndarray) -> Column:
    """array<struct<block, cells>>: the blocks that have the nearest cells, and which cells those are."""

    @F.pandas_udf("array<struct<block: int, cells: array<int>>>")
    def run(cells: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in cells:
            out = []
            for near in b:
                near = np.sort(np.asarray(near, np.int64))
                blocks = np.concatenate([np.zeros(0, np.int64), *(first[near][parts[near] > j] + j for j in range(int(parts[near].max(initial=0))))])
                of = np.concatenate([np.zeros(0, np.int64), *(near[parts[near] > j] for j in range(int(parts[near].max(initial=0))))])
                order = np.argsort(blocks, kind="stable")
                cuts = np.flatnonzero(np.diff(blocks[order])) + 1
                out.append([{"block": int(blocks[p[0]]), "cells": of[p].astype(np.int32)} for p in np.split(order, cuts) if len(p)])
            yield pd.Series(out, dtype=object)

    return run(_cells_of(vector, made, probes))


def search(indexed: DataFrame, made: Cells, queries: DataFrame, k: int, probes: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 10_000) -> DataFrame:
    """(query_id, id, score, rank) of about the k nearest rows of each query (query_id, query)."""
    spark = indexed.sparkSession
    ship(spark)
    probes = min(probes or made.probes, len(made.centroids))
    sizes = {r.cell: r["count"] for r in indexed.where("cell >= 0").groupBy("cell").count().collect()}  # at most a row a cell
    n, c = sum(sizes.values()), nearest.query_blocks(*nearest.held(queries, "query"), most)
    first, parts = _layout(sizes, len(made.centroids), max(-(-n // nearest.row_blocks(n, 4 * n * made.dims)), 1))
    where = spark.createDataFrame(pd.DataFrame({"cell": np.arange(len(first), dtype=np.int32), "first": first, "parts": parts}))
    split = F.sequence(F.lit(0), F.lit(c - 1))
    rows = indexed.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), "cell").join(F.broadcast(where), "cell")
    rows = rows.withColumn("at", F.col("first") + F.pmod(F.xxhash64("id", "vector"), F.col("parts")).cast("int"))
    rows = rows.select("id", "vector", F.array(F.col("cell").cast("int")).alias("cells"), F.explode(F.transform(split, lambda j: F.col("at") * c + j)).alias("block"))
    asked = queries.select("query_id", "query", F.explode(_asked(F.col("query"), made, probes, first, parts)).alias("a"))
    asked = asked.select("query_id", "query", "a.cells", (F.col("a.block") * c + F.pmod(F.xxhash64("query_id", "query"), F.lit(c))).cast("int").alias("block"))
    return nearest.dealt(rows, asked, k, int((first + parts).max()) * c)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact's (query_id, id) that found has too; 1 if exact is empty."""
    both = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    r = both.agg(F.count("*").alias("n"), F.count("hit").alias("hits")).first()
    return r.hits / r.n if r.n else 1.0
