"""Helpers shared by the training-data operators: session set-up, shared scratch tables, text columns."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from itertools import count, islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType

from ..ship import ship

#: Rows without an id are handled as one id below every real one.
NULL_ID = -(1 << 63)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "400", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def prepare(spark: SparkSession) -> None:
    """For operators with Python stages: ship the package, and bound an Arrow batch by rows and bytes, so that a
    worker never holds much text at once."""
    ship(spark)
    for key, value in _BATCH.items():
        spark.conf.set(key, value)  # plans are lazy and read this when they run, so it stays set


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Where the session names none, a local one is made if the
    executors are this machine's own; on a cluster each would write to its own disk, so that is refused."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if sc.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quillstream-')}"
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which goes when the application ends."""
    found = f"{shared_dir(spark)}/quillstream/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(found)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return found


@contextmanager
def _tidy(spark: SparkSession):
    """Shuffle files go as soon as an eager step has written its table."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Table:
    """A table written to the shared folder: cuts the lineage, and outlives lost executors. It goes with drop(), or when
    the application ends, as results that are read lazily may need it until then."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/quillstream/{name}-{uuid.uuid4().hex}"
        with _tidy(self.spark):
            df.write.option("compression", "zstd").parquet(self.path)
        path = self._path()
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        self.schema = df.schema

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        path = self._path()
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _path(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    return Table(df, name).df


def integral(df: DataFrame, column: str) -> Column:
    """An id column as a long. Ids are integers or null; columns of other types are refused when the plan is made. The
    one value -2**63 is taken for null."""
    kind = df.select(column).schema[0].dataType
    if not isinstance(kind, (IntegralType, NullType)):
        raise TypeError(f"{column} must hold integers or null, not {kind.simpleString()}")
    return F.col(column).cast("long")


def key_of(df: DataFrame, column: str) -> Column:
    """An id as a long, NULL_ID for null."""
    return F.coalesce(integral(df, column), F.lit(NULL_ID))


def id_of(column: str) -> Column:
    """The inverse of key_of."""
    return F.nullif(F.col(column), F.lit(NULL_ID))


def free_names(df: DataFrame, n: int) -> list[str]:
    """n column names that df does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    return list(islice((c for c in (f"_q{i}" for i in count()) if c not in taken), n))


#: A size that Catalyst gives to inputs that it knows nothing of, or to joins of such, is at least this.
_UNKNOWN = 1 << 55


def input_bytes(df: DataFrame) -> int:
    """The size of what df reads, for choosing a number of buckets: Catalyst's estimate, or where it has none a count."""
    found = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if found < _UNKNOWN:
        return found
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    return df.agg(F.sum(sum(sizes, F.lit(8).cast("long")))).first()[0] or 0


def buckets_for(df: DataFrame, bytes_each: int, least: int = 8) -> int:
    return max(least, -(-input_bytes(df) // bytes_each))
