"""Chat formatting: collapse of cumulative snapshots, then rendering. DataFrame functions only.

A logged conversation that is a proper prefix of another (same roles and texts in the same order) is a snapshot and
is dropped; of equal conversations the one with the smallest id stays. Turns are ordered by turn (null first), role
and text; repeated turn rows each count. Null role and null text equal themselves and render as nothing. A null
conv_id names one conversation, below all others.

Prefixes are found by rolling hashes: the exclusive or of two 64-bit hashes of (position, role, text), so a running
value needs no long sequential step. Positions and running values are taken inside blocks of ``block`` turn numbers
and joined with the totals of earlier blocks, so a very long conversation spreads over tasks; turns that share a number,
or have none, are one block and are sorted together. Placed turns are written once; hashing and the anti-join read narrow
columns of that, and texts are read again for the conversations that stay. An empty table gives no rows, conv_id holds
integers or null, and other columns are not looked at. Rendered conversations
come in segments of ``segment`` turns, whose texts in order are the conversation; most have one segment.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, Table, key_of


@dataclass(frozen=True)
class Settings:
    block: int = 1024
    segment: int = 256
    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    mark: str = "<|"  #: what begins a control token; written apart in contents, so that no text can forge a turn
    apart: str = "< |"


def _turns(conversations: DataFrame, s: Settings) -> DataFrame:
    """(c, b, pos, n, role, text, t1, t2): position from 1, turns of the conversation, and hashes of the turn."""
    rows = conversations.select(key_of(conversations, "conv_id").alias("c"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("b", F.coalesce(F.floor(F.col("turn") / s.block), F.lit(NULL_ID)))
    earlier = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("c")
    counts = rows.groupBy("c", "b").agg(F.count("*").alias("k"))
    counts = counts.select("c", "b", F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("before"), F.sum("k").over(whole).alias("n"))
    inside = Window.partitionBy("c", "b").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    placed = rows.join(counts, ["c", "b"]).withColumn("pos", F.col("before") + F.row_number().over(inside))
    parts = [F.col("pos"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    return placed.select("c", "b", "pos", "n", "role", "text", *(F.xxhash64(F.lit(i), *parts).alias(f"t{i}") for i in (1, 2)))


def _prefixes(placed: DataFrame) -> DataFrame:
    """(c, pos, n, p1, p2): the rolling hashes of each turn's prefix, from the hashes of turns alone."""
    earlier = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("c", "b").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    sums = sums.select("c", "b", *(F.coalesce(F.bit_xor(f"s{i}").over(earlier), F.lit(0).cast("long")).alias(f"e{i}") for i in (1, 2)))
    running = Window.partitionBy("c", "b").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.select("c", "b", "pos", "n", "t1", "t2").join(sums, ["c", "b"])
    return out.select("c", "pos", "n", *(F.bit_xor(f"t{i}").over(running).bitwiseXOR(F.col(f"e{i}")).alias(f"p{i}") for i in (1, 2)))


def maximal(turns: DataFrame) -> DataFrame:
    """(c, n, copies): conversations that are no proper prefix of another, one of each."""
    whole = turns.where("pos = n").groupBy("n", "p1", "p2").agg(F.min("c").alias("c"), F.count("*").alias("copies"))
    prefixes = turns.where("pos < n").select(F.col("pos").alias("n"), "p1", "p2").distinct()
    return whole.join(prefixes, ["n", "p1", "p2"], "left_anti").select("c", "n", "copies")


def render(role: Column, text: Column, s: Settings) -> Column:
    def safe(c: Column) -> Column:
        return F.replace(F.coalesce(c, F.lit("")), F.lit(s.mark), F.lit(s.apart))

    return F.concat(F.lit(s.open), safe(role), F.lit("\n"), safe(text), F.lit(s.close + "\n"))


def format_chats(conversations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(conv_id, segment, n_turns, n_copies, n_segment_turns, rendered) of maximal conversations."""
    # written once: the hashes are found from narrow columns of it, and texts are read again for what is kept only
    turns = Table(_turns(conversations, s), "turns").df
    kept = maximal(Table(_prefixes(turns), "prefixes").df).withColumnRenamed("c", "k")
    rows = turns.join(kept.select("k", "copies"), F.col("c") == F.col("k"))
    rows = rows.select("c", "copies", "n", "pos", F.floor((F.col("pos") - 1) / s.segment).alias("segment"), render(F.col("role"), F.col("text"), s).alias("r"))
    out = rows.groupBy("c", "segment").agg(F.first("n").alias("n_turns"), F.first("copies").alias("n_copies"), F.count("*").alias("n_segment_turns"), F.array_sort(F.collect_list(F.struct("pos", "r"))).alias("t"))
    return out.select(F.nullif("c", F.lit(NULL_ID)).alias("conv_id"), "segment", "n_turns", "n_copies", "n_segment_turns", F.array_join(F.transform("t", lambda x: x.r), "").alias("rendered"))


ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
         struct_pack(r := role, x := text) AS one, role, text
  FROM conversations
), c AS (
  SELECT conv_id, list(one ORDER BY pos) AS whole, count(*) AS n FROM t GROUP BY conv_id
), u AS (
  SELECT whole, n, nullif(min(coalesce(conv_id, -9223372036854775808)), -9223372036854775808) AS conv_id, count(*) AS n_copies FROM c GROUP BY whole, n
), p AS (
  SELECT DISTINCT whole[1:i] AS part FROM (SELECT whole, unnest(range(1, n)) AS i FROM u)
), k AS (
  SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.part = u.whole)
)
SELECT k.conv_id, (t.pos - 1) // 256 AS segment, k.n AS n_turns, k.n_copies, count(*) AS n_segment_turns,
       string_agg('<|im_start|>' || replace(coalesce(t.role, ''), '<|', '< |') || chr(10)
                  || replace(coalesce(t.text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY t.pos) AS rendered
FROM k JOIN t ON t.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY ALL
"""
