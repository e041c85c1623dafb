"""Sharding along a Hilbert curve. DataFrame functions only.

Several metadata dimensions (source, language, size) are quantised to 2**bits ranges each, at quantiles of their
values; the ranges' cells are ordered by their place on a Hilbert curve, and the rows in that order are cut into runs
of equal length. A shard then covers a compact region of all dimensions, so the minima and maxima of its files prune
on any of them. The law is ``rows``: counts differ by one at most.

The quantiles are exact at every size: values are counted in ranges, and the ranges that hold a wanted rank are split
again until each is one value, so the driver gets a bounded number of counts a pass.

Strings are quantised by the seven bytes after the common prefix of the smallest and largest value; null is lowest.
A row's rank is its cell's offset plus its rank in the cell, and a cell is split by a hash of the id, so a cell that
holds most rows spreads over tasks. Ties are broken by id, size and checksum; rows that repeat differ in slot only.
No table beyond the cells (2**(bits * dimensions), a constant) is broadcast or ordered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, Table, key_of


@dataclass(frozen=True)
class Settings:
    shards: int = 24
    bits: int = 4
    ranges: int = 1024  #: that an interval of values is split into, for the quantiles
    rows_each: int = 1 << 20  #: rows ranked by one task, about
    strings: tuple[str, ...] = ("source", "lang")


def hilbert(x: Column, bits: int, dims: int) -> Column:
    """Place on the curve of the cell with the coordinates in the array x (Skilling's transform)."""
    steps = F.array(*(F.struct(F.lit(1 << q).alias("q"), F.lit(i).alias("i")) for q in range(bits - 1, 0, -1) for i in range(dims)))

    def turn(v: Column, s: Column) -> Column:
        first, one, low = F.get(v, F.lit(0)), F.get(v, s.i), s.q - 1
        swap = first.bitwiseXOR(one).bitwiseAND(low)
        high = one.bitwiseAND(s.q) != 0
        return F.transform(v, lambda y, j: F.when(j == 0, F.when(high, y.bitwiseXOR(low)).otherwise(y.bitwiseXOR(swap))).when((j == s.i) & ~high, y.bitwiseXOR(swap)).otherwise(y))

    turned = F.aggregate(steps, x, turn)
    gray = F.aggregate(turned, F.array().cast("array<int>"), lambda a, y: F.concat(a, F.array(y.bitwiseXOR(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))))))
    last = F.element_at(gray, dims)
    flip = F.aggregate(F.array(*(F.lit(1 << q) for q in range(bits - 1, 0, -1))), F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
    done = F.transform(gray, lambda y: y.bitwiseXOR(flip))
    order = F.array(*(F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(dims)))
    weight = F.array(*(F.lit(1 << q) for q in range(bits)))
    return F.aggregate(order, F.lit(0), lambda h, s: h * 2 + F.when(F.get(done, s.i).bitwiseAND(F.get(weight, s.b)) != 0, 1).otherwise(0))


def _code(value: Column, skip: int) -> Column:
    """The order of strings as a long: seven bytes from a place on; null is -1."""
    tail = F.rpad(F.hex(F.substring(value.cast("binary"), skip + 1, 7)), 14, "0")
    return F.coalesce(F.conv(tail, 16, 10).cast("long"), F.lit(-1).cast("long"))


def _common(a: str | None, b: str | None) -> int:
    a, b = (a or "").encode(), (b or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def quantiles(values: DataFrame, bounds: list[tuple[int, int]], ranks: list[int], ranges: int) -> list[list[int]]:
    """The values of each column at the ranks (from 1) of its order. values: columns of longs without null, within bounds.

    An interval is (its least and largest value, the rows below it, the ranks in it).
    """
    found: list[dict[int, int]] = [{} for _ in bounds]
    todo = [[(lo, hi, 0, ranks)] if ranks else [] for lo, hi in bounds]
    while any(todo):
        cases = []
        for i, c in enumerate(values.columns):
            case = F.lit(None)
            for j, (lo, hi, *_) in enumerate(todo[i]):
                at = F.expr(f"(`{c}` - {lo}L) div {(hi - lo) // ranges + 1}L")
                case = F.when(F.col(c).between(lo, hi), F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), at.alias("at"), F.col(c).alias("v"))).otherwise(case)
            cases += [case] * bool(todo[i])
        placed = values.select(F.explode(F.array_compact(F.array(*cases))).alias("p"))
        counted: dict[tuple[int, int], list] = {}
        # at most ranges x ranks a column
        for r in placed.groupBy("p.i", "p.j", "p.at").agg(F.count("*").alias("n"), F.min("p.v").alias("lo"), F.max("p.v").alias("hi")).collect():
            counted.setdefault((r.i, r.j), []).append((r.at, r.n, r.lo, r.hi))
        again: list[list] = [[] for _ in bounds]
        for (i, j), groups in counted.items():
            *_, below, wanted = todo[i][j]
            for _, n, lo, hi in sorted(groups):
                mine = [k for k in wanted if below < k <= below + n]
                if mine and lo == hi:
                    found[i] |= dict.fromkeys(mine, lo)
                elif mine:
                    again[i].append((lo, hi, below, mine))
                below += n
        todo = again
    return [[f[k] for k in ranks] for f in found]


def shard(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard (null), curve."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    meta = docs.select(
        key_of(docs, id_col).alias("k"), F.octet_length(text).cast("long").alias("bytes"), F.crc32(text.cast("binary")).alias("crc"),
        *(F.col(c).cast("string").alias(f"d{i}") for i, c in enumerate(s.strings)),
    )
    meta = Table(meta, "shard-meta").df
    names = range(len(s.strings))
    ends = meta.agg(F.count("*").alias("n"), F.max("bytes").alias("most"), *(f(f"d{i}").alias(f"{w}{i}") for i in names for w, f in (("lo", F.min), ("hi", F.max)))).first()
    codes = [_code(F.col(f"d{i}"), _common(ends[f"lo{i}"], ends[f"hi{i}"])) for i in names] + [F.col("bytes")]
    top = 1 << s.bits
    ranks = [-(-i * ends.n // top) for i in range(1, top)] if ends.n else []
    cuts = quantiles(meta.select(*(c.alias(f"c{i}") for i, c in enumerate(codes))), [*((-1, (1 << 56) - 1) for _ in names), (0, ends.most)], ranks, s.ranges)
    dims = len(codes)
    cell = F.lit(0)
    for i, c in enumerate(codes):
        place = sum(((c > cut).cast("int") for cut in cuts[i]), F.lit(0))
        cell = cell * (1 << s.bits) + place
    split = max(64, ends.n // (4 * s.rows_each))
    part = F.conv(F.substring(F.md5(F.col("k").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % split
    rows = meta.select("k", "bytes", "crc", cell.alias("cell"), part.alias("part"))

    spark = docs.sparkSession
    mask = (1 << s.bits) - 1
    at = F.col("id").cast("int")
    curve = spark.range(1 << (s.bits * dims)).select(at.alias("cell"), hilbert(F.array(*(F.shiftright(at, s.bits * (dims - 1 - i)).bitwiseAND(F.lit(mask)) for i in range(dims))), s.bits, dims).cast("long").alias("curve"))
    counts = rows.groupBy("cell", "part").agg(F.count("*").alias("m"))
    cells = counts.groupBy("cell").agg(F.sum("m").alias("m")).join(F.broadcast(curve), "cell")
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as cells
    cells = cells.select("cell", "curve", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.withColumn("off", F.coalesce(F.sum("m").over(inside), F.lit(0))).join(F.broadcast(cells), "cell").select("cell", "part", "curve", (F.col("start") + F.col("off")).alias("start"))
    one = Window.partitionBy("cell", "part").orderBy("k", "bytes", "crc")
    placed = rows.join(parts, ["cell", "part"]).withColumn("rank", F.col("start") + F.row_number().over(one) - 1)
    m = s.shards
    number = F.expr(f"(rank * {m}L) div {max(1, ends.n)}L")
    first = F.expr(f"(shard * {ends.n}L + {m - 1}L) div {m}L")
    return placed.withColumn("shard", number.cast("int")).select(
        F.nullif("k", F.lit(NULL_ID)).alias("doc_id"), (F.col("bytes") + 8).alias("size"), F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write_shards(docs: DataFrame, path: str, s: Settings = Settings(), files_each: int = 4) -> None:
    """Writes docs as Parquet under shard=N folders in slot order. docs' ids must be unique for this join."""
    placed = shard(docs, s).select(F.col("doc_id").alias("_id"), "shard", "slot")
    out = docs.join(placed, key_of(docs, "doc_id") == F.coalesce("_id", F.lit(NULL_ID)))
    out = out.repartitionByRange(s.shards * files_each, "shard", "slot").sortWithinPartitions("shard", "slot")
    out.drop("_id").write.partitionBy("shard").parquet(path)


def _oracle(bits: int = 4, shards: int = 24) -> str:
    """The same order in DuckDB: the curve step by step over a table of cells, quantiles and ranks by window functions."""
    top = 1 << bits
    steps, prev, n = [], "x0", 0
    for q in range(bits - 1, 0, -1):
        for d in "abc":
            n += 1
            low = (1 << q) - 1
            t = f"(xor(a, {d}) & {low})"
            new = {c: c for c in "abc"}
            if d == "a":
                new["a"] = f"CASE WHEN (a >> {q}) & 1 = 1 THEN xor(a, {low}) ELSE a END"
            else:
                new["a"] = f"CASE WHEN ({d} >> {q}) & 1 = 1 THEN xor(a, {low}) ELSE xor(a, {t}) END"
                new[d] = f"CASE WHEN ({d} >> {q}) & 1 = 1 THEN {d} ELSE xor({d}, {t}) END"
            steps.append(f"x{n} AS (SELECT cell, {', '.join(f'{v} AS {c}' for c, v in new.items())} FROM {prev})")
            prev = f"x{n}"
    flip = "0"
    for q in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN (c >> {q}) & 1 = 1 THEN {(1 << q) - 1} ELSE 0 END)"
    index = " + ".join(f"((({c} >> {b}) & 1) << {3 * b + 2 - i})" for b in range(bits) for i, c in enumerate("abc"))
    code = "coalesce(('0x' || rpad(hex(encode(v))[2 * skip + 1 : 2 * skip + 14], 14, '0'))::BIGINT, -1)"
    lcp = lambda c: f"(SELECT coalesce(max(i), 0) FROM range(1, 100) r(i), (SELECT min({c}) AS lo, max({c}) AS hi FROM documents) WHERE length(lo) >= i AND lo[1:i] = hi[1:i])"
    coded = lambda c: code.replace("encode(v)", f"encode({c})").replace("skip", lcp(c))
    cut = lambda c: f"(SELECT list({c} ORDER BY {c}) FROM m)"
    place = lambda c: f"len(list_filter(range(1, {top}), lambda i: {c} > {c}s[ceil(i * n / {top}.0)::BIGINT]))"
    return f"""
WITH tbl AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))
), m AS (
  SELECT coalesce(doc_id, -9223372036854775808) AS k, strlen(coalesce(text, ''))::BIGINT AS s,
         {coded("source")} AS p, {coded("lang")} AS g,
         xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS crc
  FROM documents, tbl
), l AS (SELECT {cut("p")} AS ps, {cut("g")} AS gs, {cut("s")} AS ss, (SELECT count(*) FROM m) AS n
), r AS (
  SELECT k, s, crc, ({place("p")} * {top} + {place("g")}) * {top} + {place("s")} AS cell,
         ('0x' || md5(k::VARCHAR)[1:8])::BIGINT % greatest(64, n // 4194304) AS part, n
  FROM m, l
), x0 AS (SELECT i AS cell, (i >> {2 * bits}) & {top - 1} AS a, (i >> {bits}) & {top - 1} AS b, i & {top - 1} AS c FROM range({top**3}) q(i)
), {", ".join(steps)}, g1 AS (SELECT cell, a, xor(b, a) AS b, xor(c, xor(b, a)) AS c FROM {prev}
), g2 AS (SELECT cell, xor(a, f) AS a, xor(b, f) AS b, xor(c, f) AS c FROM (SELECT *, {flip} AS f FROM g1)
), curve AS (SELECT cell, {index} AS curve FROM g2
), o AS (SELECT *, row_number() OVER (ORDER BY curve, part, k, s, crc) - 1 AS rank FROM r JOIN curve USING (cell)
), h AS (SELECT *, (rank * {shards} // n)::INTEGER AS shard FROM o)
SELECT nullif(k, -9223372036854775808) AS doc_id, s + 8 AS size, crc::BIGINT AS text_crc32, 'rows' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY rank) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard, curve::BIGINT AS curve
FROM h
"""


ORACLE = _oracle()
