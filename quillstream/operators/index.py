"""The chunk index: a fixed schema, runs in folders behind a pointer, upserts, deletes and exact search.

A run is a Parquet folder that is written whole and then named by a small file that is renamed into place, so readers
see the index before a write or after it, and a lost executor or driver leaves the old one in place.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Settings
from ..functions.text import basename, breadcrumb
from . import nearest
from .embed import embed


def _field(name: str, kind: T.DataType, *roles: str, null: bool = True) -> T.StructField:
    return T.StructField(name, kind, null, {"roles": list(roles)})


SCHEMA = T.StructType([
    _field("id", T.StringType(), "key", "filter", null=False), _field("chunk_content", T.StringType(), "search", "semantic_content"),
    _field("content_vector", T.ArrayType(T.FloatType()), "vector"), _field("document_title", T.StringType(), "search", "filter", "sort", "semantic_title"),
    _field("source_url", T.StringType(), "filter"), _field("source_type", T.StringType(), "filter", "facet", "semantic_keywords"),
    _field("file_name", T.StringType(), "filter", "facet", "semantic_keywords"),
    _field("breadcrumb", T.StringType(), "search", "filter", "semantic_keywords"), _field("chunk_index", T.IntegerType(), "filter", "sort"), _field("total_chunks", T.IntegerType(), "filter"),
    _field("page_number", T.IntegerType(), "filter", "sort"), _field("last_modified", T.TimestampType(), "filter", "sort"), _field("ingested_at", T.TimestampType(), "filter", "sort"),
    _field("pii_redacted", T.BooleanType(), "filter", "facet"), _field("file_path", T.StringType(), "internal"),
])


def pushable(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("content_vector").isNotNull())


def merge(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """old with new's rows put in by key; a field that new leaves null keeps its old value."""
    left, right = old.alias("o"), new.alias("n")
    joined = left.join(right, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    return joined.select(*(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in old.columns))


def without(index: DataFrame, paths: DataFrame, key: str = "file_path") -> DataFrame:
    """index without the chunks of the documents in paths."""
    return index.join(paths.select(key).distinct(), key, "left_anti")


def without_compatible(index: DataFrame, paths: DataFrame) -> DataFrame:
    """The same by file name and breadcrumb, which documents of different roots may share."""
    gone = paths.select(basename(F.col("file_path")).alias("file_name"), breadcrumb(F.col("file_path")).alias("breadcrumb")).distinct()
    return index.join(gone, ["file_name", "breadcrumb"], "left_anti")


def replace(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """index with the documents of chunks replaced. A document none of whose chunks has a vector stays as it was."""
    good = pushable(chunks)
    return without(index, good).unionByName(good.select(*index.columns))


def accounting(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count_if(F.col("content_vector").isNotNull()).alias("success"), F.count_if(F.col("content_vector").isNull()).alias("skipped"))


def search(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 10_000) -> DataFrame:
    """The k nearest rows of each query (query_id, query), exactly: (query_id, id, score, rank). Ties to 9 places go to the smaller id.

    The score is the cosine similarity in double precision: null if a vector is missing or has length 0, which ranks last.
    Rows and queries are dealt into blocks, of at most about ``most`` queries, and each block of rows meets each of queries.
    """
    r, c = nearest.row_blocks(*nearest.held(vectors, vector_col)), nearest.query_blocks(*nearest.held(queries, "query"), most)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.lit(None).cast("array<int>").alias("cells"))
    rows = rows.withColumn("block", F.explode(F.transform(F.sequence(F.lit(0), F.lit(c - 1)), lambda j: j + c * F.pmod(F.xxhash64("id", "vector"), F.lit(r)).cast("int"))))
    asked = queries.select("query_id", "query", F.lit(None).cast("array<int>").alias("cells"))
    asked = asked.withColumn("block", F.explode(F.transform(F.sequence(F.lit(0), F.lit(r - 1)), lambda i: i * c + F.pmod(F.xxhash64("query_id", "query"), F.lit(c)).cast("int"))))
    return nearest.dealt(rows, asked, k, r * c)


def text_queries(queries: DataFrame, model, s: Settings = Settings(), text_col: str = "query_text") -> DataFrame:
    """(query_id, query) of queries given as text: the same sanitising, cutting and model as for chunks."""
    made = embed(queries.select("query_id", F.col(text_col).alias("chunk_content")), model, s)
    return made.select("query_id", F.col("content_vector").alias("query"))


def quantise(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Adds codes: each dimension's range over all rows cut into 256 steps, from -128 to 127."""
    each = vectors.select(F.posexplode(vector_col).alias("d", "x")).groupBy("d").agg(F.min("x").cast("double").alias("lo"), F.max("x").cast("double").alias("hi"))
    ranges = each.agg(F.array_sort(F.collect_list(F.struct("d", "lo", "hi"))).alias("_r"))  # a row, as long as a vector
    code = F.transform(F.arrays_zip(F.col(vector_col).alias("x"), F.col("_r").alias("r")), lambda z: F.when(z.r.hi > z.r.lo, F.floor((z.x.cast("double") - z.r.lo) / (z.r.hi - z.r.lo) * 255 + 0.5) - 128).otherwise(0).cast("int"))
    return vectors.join(F.broadcast(ranges)).withColumn("codes", code).drop("_r")


def _latest(runs: list[DataFrame]) -> DataFrame:
    """The rows of runs, oldest first, without those whose document is in a later run.

    Only the paths of the later runs are joined to all rows, narrow and read once more; Catalyst broadcasts them if
    they are small. Rows without a path are replaced by none.
    """
    if len(runs) == 1:
        return runs[0]
    numbered = [r.withColumn("_run", F.lit(i)) for i, r in enumerate(runs)]
    later = reduce(DataFrame.unionByName, [r.select("file_path", "_run") for r in numbered[1:]])
    last = later.groupBy(F.col("file_path").alias("_path")).agg(F.max("_run").alias("_last"))
    rows = reduce(DataFrame.unionByName, numbered)
    return rows.join(last, (F.col("file_path") == F.col("_path")) & (F.col("_run") < F.col("_last")), "left_anti").drop("_run")


class Store:
    """An index in a folder of any Hadoop file system, as runs: folders of rows, oldest first, named by a pointer file.

    put() writes the batch alone; a document's rows are those of the last run it is in. A run that is smaller than all
    later ones together is merged with them, so run sizes at least double from new to old: there are at most
    log2(rows) runs, and a row is rewritten about as often. One writer at a time. What the last ``keep`` pointers do
    not name is deleted, so a frame from read() can be used until ``keep`` writes later.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.root))

    def _names(self, start: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._path(self.root)) if f.getPath().getName().startswith(start))

    def _pointer(self, name: str) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def state(self) -> dict:
        """{"runs": names, oldest first, "batch": number} of the last complete write."""
        found = self._names("done-")
        return self._pointer(found[-1]) if found else {"runs": [], "batch": -1}

    def _run(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/{name}")

    def _bytes(self, name: str) -> int:
        return self._fs.getContentSummary(self._path(f"{self.root}/{name}")).getLength()

    def _save(self, rows: DataFrame, name: str) -> str:
        rows.select(*SCHEMA.names).write.mode("overwrite").parquet(f"{self.root}/{name}")
        return name

    def _commit(self, runs: list[str], batch: int) -> None:
        new = self._path(f"{self.root}/next-{batch:012d}")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps({"runs": runs, "batch": batch}).encode()))
        out.close()
        self._fs.rename(new, self._path(f"{self.root}/done-{batch:012d}"))  # what makes the runs the current ones
        pointers = self._names("done-")
        named = {r for p in pointers[-self.keep :] for r in self._pointer(p)["runs"]}
        for name in pointers[: -self.keep] + [r for r in self._names("run-") if r not in named]:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def read(self) -> DataFrame:
        runs = self.state()["runs"]
        return _latest([self._run(r) for r in runs]) if runs else self.spark.createDataFrame([], SCHEMA)

    def write(self, index: DataFrame, batch: int) -> None:
        """index in place of all that is stored; a batch that is already in is left out."""
        if batch > self.state()["batch"]:
            self._commit([self._save(index, f"run-{batch:012d}")], batch)

    def put(self, chunks: DataFrame, batch: int) -> None:
        """Replaces the documents of chunks, as replace() does; a batch that is already in is left out."""
        old = self.state()
        if batch <= old["batch"]:
            return
        runs = [*old["runs"], self._save(pushable(chunks), f"run-{batch:012d}")]
        sizes, first, later = [self._bytes(r) for r in runs], len(runs) - 1, 0
        for i in range(len(runs) - 2, -1, -1):
            later += sizes[i + 1]
            first = i if sizes[i] < later else first
        if first < len(runs) - 1:
            runs[first:] = [self._save(_latest([self._run(r) for r in runs[first:]]), f"run-{batch:012d}-merged")]
        self._commit(runs, batch)
