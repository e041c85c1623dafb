"""Connected components of a graph held in a DataFrame, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table


def _large(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """edges: (a long, b long), undirected. Returns (node, root) for each node that is not its component's smallest.

    Each round writes its edges to the shared folder, and the driver sees only a count and a checksum. Rounds grow
    with the logarithm of the number of nodes.
    """
    now = Table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.count_distinct("a").alias("d")).first()
        if state == before or not state.n:
            return now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        after = Table(_small(_large(now.df).distinct()).distinct(), "edges")
        now.drop()
        now = after
