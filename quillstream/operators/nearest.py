"""The k nearest rows of each query by cosine similarity, over a grid of blocks of rows and blocks of queries.

Every pair of blocks is a task of its own, with bounded memory and without a part for the driver: pairs are as many as
rows times queries, tasks are dealt over the cluster, and each sends k rows a query. A product of matrices in single
precision tells which pairs may be among the k best, by a bound of its error; their scores are then summed again in
double precision, dimension by dimension, as the SQL does. So the answer is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..ship import ship

ROW_BYTES = 8 << 20  #: of vectors in a block of rows
QUERY_BYTES = 8 << 20  #: of vectors in a block of queries
LEAST_BLOCKS = 32  #: of rows, if they have so many times LEAST_ROWS
LEAST_ROWS = 256
CUT_ROWS, CUT_QUERIES, CUT_HITS = 4096, 512, 1 << 19  #: of a block, worked on together


def held(rows: DataFrame, vector_col: str) -> tuple[int, int]:
    """How many rows there are, and the bytes of their vectors."""
    found = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.greatest(F.size(vector_col), F.lit(0)).cast("long") * 4), F.lit(0)).alias("b")).first()
    return found.n, found.b


def row_blocks(n: int, size: int) -> int:
    return max(-(-size // ROW_BYTES), min(LEAST_BLOCKS, n // LEAST_ROWS), 1)


def query_blocks(n: int, size: int, most: int) -> int:
    return max(-(-n // most), -(-size // QUERY_BYTES), 1)


def dealt(rows: DataFrame, queries: DataFrame, k: int, blocks: int) -> DataFrame:
    """(query_id, id, score, rank) of the k best of rows (block, id, vector, cells) for queries (block, query_id, query, cells) of
    the same block. With cells, a row (which has one) is for the queries that have its cell. Ties to 9 places go to the smaller id."""
    ship(rows.sparkSession)
    kinds = dict(rows.select("id").dtypes) | dict(queries.select("query_id").dtypes)
    left = rows.select("block", F.lit(False).alias("asks"), F.lit(None).cast(kinds["query_id"]).alias("query_id"), "id", F.col("vector").alias("v"), "cells")
    right = queries.select("block", F.lit(True).alias("asks"), "query_id", F.lit(None).cast(kinds["id"]).alias("id"), F.col("query").alias("v"), "cells")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = defaultdict(list)
        for b in batches:
            at = b.column("block").to_numpy()
            for g in np.unique(at):
                parts[g].append(b.filter(pa.array(at == g)))
        for g in list(parts):
            yield from _best(pa.Table.from_batches(parts.pop(g)).combine_chunks(), k)

    found = left.unionByName(right).repartitionById(blocks, F.col("block").cast("int")).mapInArrow(run, f"query_id {kinds['query_id']}, id {kinds['id']}, score double, key double")
    order = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("key"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("key")


def round9(x: np.ndarray) -> np.ndarray:
    """To 9 places, halves away from zero."""
    y = x * 1e9
    whole = np.trunc(y)
    return (whole + np.copysign(np.abs(y - whole) >= 0.5, y)) / 1e9


def _squares(x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.shape[1])
    for row in x:
        out += row * row
    return out


class _Vectors:
    """Vectors by their number of dimensions, a column each. What has a null in it counts as null."""

    def __init__(self, column: pa.ListArray):
        lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, starts = column.values, column.offsets.to_numpy()[:-1].astype(np.int64)
        if flat.null_count:
            nulls = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
            lengths[nulls[starts + np.maximum(lengths, 0)] > nulls[starts]] = -1
            flat = flat.fill_null(0)
        flat = flat.to_numpy()
        self.n, self.of = len(column), {}
        for d in np.unique(lengths[lengths >= 0]).tolist():
            at = np.flatnonzero(lengths == d)
            with np.errstate(all="ignore"):
                x = flat[starts[at] + np.arange(d)[:, None]].astype(np.float64).reshape(d, len(at))
                squares = _squares(x)
            self.of[d] = at, x, squares, np.isfinite(squares) & (squares > 0), ~np.isfinite(squares)


def _one_each(x: np.ndarray, cell: np.ndarray, k: int) -> np.ndarray:
    """The first k of equal vectors of a cell, in order: the others cannot be among the k best."""
    rows = np.ascontiguousarray(np.concatenate([x, cell[None].astype(np.float64)]).T)
    _, of = np.unique(rows.view(np.dtype((np.void, rows.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.argsort(of, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(of[order]) > 0]))
    place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    return np.sort(order[place < k])


def _top(x, xx, cell, q, qq, probed, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score, key) of the k best usable rows x of each usable query q; the rows are ordered by id. probed
    tells which cells a query asks, or is None."""
    error = (len(x) + 16) * 2.0**-23 + 1e-8
    kept = _one_each(x, cell, k)
    kept = kept[np.argsort(cell[kept], kind="stable")]
    xu = np.ascontiguousarray((x[:, kept] / np.sqrt(xx[kept])).T.astype(np.float32))
    out = []
    for a in range(0, q.shape[1], CUT_QUERIES):
        qs = slice(a, min(a + CUT_QUERIES, q.shape[1]))
        n = qs.stop - a
        qu = np.ascontiguousarray((q[:, qs] / np.sqrt(qq[qs])).T.astype(np.float32))
        found = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.float64))
        least = np.full(n, -np.inf)  # the k-th best key so far
        for b in range(0, len(kept), CUT_ROWS):
            rows = kept[b : b + CUT_ROWS]
            asks = np.arange(n)
            if probed is not None:
                asks = np.flatnonzero(probed[qs][:, np.unique(cell[rows])].any(axis=1))
                if not len(asks):
                    continue
            near = qu[asks] @ xu[b : b + CUT_ROWS].T
            if probed is not None:
                near[~probed[a + asks][:, cell[rows]]] = -np.inf
            bound = least[asks]
            if len(rows) > k:
                new = np.flatnonzero(np.isneginf(bound))
                bound[new] = np.partition(near[new], -k, axis=1)[:, -k]
            hit, row = np.nonzero((near >= (bound - error).astype(np.float32)[:, None]) & (near > -2))
            for c in range(0, len(hit), CUT_HITS):
                i, r = asks[hit[c : c + CUT_HITS]], rows[row[c : c + CUT_HITS]]
                dot = np.zeros(len(i))
                for d in range(len(x)):
                    dot += x[d, r] * q[d, a + i]
                score = dot / (np.sqrt(xx[r]) * np.sqrt(qq[a + i]))
                found = tuple(np.concatenate(p) for p in zip(found, (i, r, score, round9(score))))
                order = np.lexsort((found[1], -found[3], found[0]))
                place = np.arange(len(order)) - np.searchsorted(found[0][order], found[0][order])
                found = tuple(p[order[place < k]] for p in found)
                counts = np.bincount(found[0], minlength=n)
                least = np.where(counts >= k, found[3][np.maximum(np.cumsum(counts) - 1, 0)], -np.inf)
        out.append((found[0] + a, *found[1:]))
    return tuple(np.concatenate(p) for p in zip(*out))


_NO_VECTORS = np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), np.zeros(0, bool), np.zeros(0, bool)


def _probed(lists: pa.ListArray, at: np.ndarray, cells: int) -> np.ndarray:
    out = np.zeros((len(at), cells), bool)
    for i, j in enumerate(at.tolist()):
        asked = lists[j].values.to_numpy()
        out[i, asked[asked < cells]] = True
    return out


def _best(t: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    asks = t.column("asks")
    rows, queries = t.filter(pc.invert(asks)), t.filter(asks)
    if not rows.num_rows or not queries.num_rows:
        return
    one = lambda table, name: pa.concat_arrays(table.column(name).chunks)
    rows = rows.take(pc.array_sort_indices(one(rows, "id"), null_placement="at_start"))
    x, q = _Vectors(one(rows, "v")), _Vectors(one(queries, "v"))
    lists = one(queries, "cells")
    in_cells = lists.null_count == 0
    cell = one(rows, "cells").flatten().to_numpy().astype(np.int64) if in_cells else np.zeros(rows.num_rows, np.int64)
    made = []

    def give(query: np.ndarray, row: np.ndarray, score: float | None) -> None:
        """The first k of row to each of query, with one score."""
        row = row[:k]
        same = np.full(len(query) * len(row), score or 0.0)
        made.append((np.repeat(query, len(row)), np.tile(row, len(query)), same, same, np.full(len(same), score is None)))

    def others(row: np.ndarray) -> np.ndarray:
        return np.setdiff1d(np.arange(x.n), row)

    for d, (at, v, squares, good, odd) in q.of.items():
        xat, xv, xsquares, xgood, xodd = x.of.get(d, _NO_VECTORS)
        if good.any() and xgood.any():
            i, r, score, key = _top(xv[:, xgood], xsquares[xgood], cell[xat[xgood]], v[:, good], squares[good], _probed(lists, at[good], cell.max() + 1) if in_cells else None, k)
            made.append((at[good][i], xat[xgood][r], score, key, np.zeros(len(i), bool)))
        if not in_cells:  # no score where a vector has no length or another number of dimensions, NaN where one is not finite
            for who, nan, scored in ((good, xodd, xgood | xodd), (~good & ~odd, xodd, xodd), (odd, xodd | True, xodd | True)):
                if who.any():
                    give(at[who], xat[nan], np.nan)
                    give(at[who], others(xat[scored]), None)
    if not in_cells:
        give(np.setdiff1d(np.arange(q.n), np.concatenate([np.zeros(0, np.int64), *(g[0] for g in q.of.values())])), np.arange(x.n), None)
    if made:
        i, r, score, key, none = (np.concatenate(p) for p in zip(*made))
        columns = [one(queries, "query_id").take(pa.array(i)), one(rows, "id").take(pa.array(r)), pa.array(score, mask=none), pa.array(key, mask=none)]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "id", "score", "key"])
