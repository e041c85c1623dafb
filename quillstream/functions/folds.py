"""Greedy packing of an array's items, in order, into runs under limits.

A run is closed when the next item would exceed a limit, so its ends depend on all before it and no window frame can
express them. The fold runs over one document's array inside a row; nothing is shuffled for it. It carries run starts
alone, which are few, and not the items.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pack(sizes: Column, limit: int, most: int | None = None, alone: bool = False) -> Column:
    """array<struct<start: int, n: int, total: long>> of runs (start from 1) of an array of sizes.

    A run closes before an item that would bring its total over ``limit`` or its items over ``most``. With ``alone``
    an item of ``limit`` or more is a run of its own.
    """
    state = F.struct(F.array().cast("array<struct<start: int, total: bigint>>").alias("done"), F.lit(0).alias("start"), F.lit(0).cast("long").alias("total"), F.lit(False).alias("shut"), F.lit(0).alias("i"))

    def step(s: Column, size: Column) -> Column:
        i = s.i + 1
        closes = s.shut | (s.total + size > limit)
        if most is not None:
            closes = closes | (i - s.start >= most)
        if alone:
            closes = closes | (size >= limit)
        new = (s.start == 0) | closes
        closed = F.array(F.struct(s.start.alias("start"), s.total.alias("total")))
        return F.struct(
            F.when((s.start > 0) & closes, F.concat(s.done, closed)).otherwise(s.done).alias("done"), F.when(new, i).otherwise(s.start).alias("start"),
            F.when(new, size).otherwise(s.total + size).alias("total"), (F.lit(alone) & (size >= limit)).alias("shut"), i.alias("i"),
        )

    def finish(s: Column) -> Column:
        runs = F.when(s.start > 0, F.concat(s.done, F.array(F.struct(s.start.alias("start"), s.total.alias("total"))))).otherwise(s.done)
        ends = F.concat(F.transform(runs, lambda r: r.start), F.array(s.i + 1))
        return F.transform(runs, lambda r, k: F.struct(r.start.alias("start"), (F.get(ends, k + 1) - r.start).alias("n"), r.total.alias("total")))

    return F.aggregate(sizes, state, step, finish)
