"""Documents as files: batch and streaming reads, with guards before any content is read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ALLOWED_EXTENSIONS, Settings
from ..functions.text import utc_stamp
from ..ship import ship


def _below(root: str) -> Column:
    """A listed file's path under root."""
    base = root.rstrip("/").partition(":")[2].lstrip("/") or root.strip("/")
    return F.substring("path", F.instr("path", base) + len(base) + 1, F.length("path"))


def _shape(raw: DataFrame, root: str, s: Settings) -> DataFrame:
    found, path = F.col("path"), _below(root)
    return raw.where((F.col("length") > 0) & (F.col("length") <= s.max_file_bytes) & ~found.endswith(".error.json")).select(
        path.alias("file_path"), "length", F.col("modificationTime").alias("modified"), utc_stamp(F.col("modificationTime")).alias("last_modified"), "content"
    )


def oversize(spark: SparkSession, root: str, s: Settings = Settings()) -> DataFrame:
    """(file_path, length, reason) of files that read_files leaves out for their size; their content is not read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.col("length") > s.max_file_bytes)
    return raw.select(_below(root).alias("file_path"), "length", F.concat(F.lit("file of "), F.col("length").cast("string"), F.lit(f" bytes exceeds the limit of {s.max_file_bytes}")).alias("reason"))


def fetch(named: DataFrame, root: str, s: Settings = Settings()) -> DataFrame:
    """Adds length, content and read_error to rows with blob_path, whose files lie under root: for notifications, which
    name files one by one. A file that is missing or over the size guard gets an error in its row, and no content."""
    ship(named.sparkSession)
    most = s.max_file_bytes

    @F.pandas_udf("struct<length: long, content: binary, read_error: string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = (fs.LocalFileSystem(), "/" + root[5:].lstrip("/")) if root.startswith("file:") else fs.FileSystem.from_uri(root)
        for paths in batches:
            yield pd.DataFrame([_read(files, f"{base.rstrip('/')}/{p}", most) for p in paths], columns=["length", "content", "read_error"])

    return named.withColumn("_f", run.asNondeterministic()("blob_path")).select(*named.columns, "_f.*")


def _read(files, path: str, most: int) -> tuple[int | None, bytes | None, str | None]:
    try:
        size = files.get_file_info(path).size
        if size is None:
            return None, None, "no such file"
        if size > most:
            return size, None, f"file of {size} bytes exceeds the limit of {most}"
        with files.open_input_stream(path) as f:
            return size, f.read(), None
    except OSError as e:
        return None, None, f"{type(e).__name__}: {e}"


def read_files(spark: SparkSession, root: str, s: Settings = Settings(), streaming: bool = False) -> DataFrame:
    """(file_path, length, modified, last_modified, content) of admitted files under root.

    The length guard reaches the scan as a pushed filter, and the name filter as a glob, so rejected files are not read.
    """
    names = "*{" + ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e) for e in ALLOWED_EXTENSIONS) + "}"
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names)
    if streaming:
        reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    return _shape(reader.load(root), root, s)
