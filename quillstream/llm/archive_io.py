"""Archives in the shared folder: written whole by tasks, listed in a manifest table, read by byte ranges.

Files are opened with pyarrow's file systems (file, hdfs, s3, gs). A task attempt writes files under names of its own
and returns them as manifest rows; only rows of attempts that Spark commits are in the manifest, so files of lost or
repeated attempts are never read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import InputPartition

from .common import Table


def place(uri: str):
    """(file system, path) of a URI or local path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, suffix: str, data: bytes) -> str:
    files, path = place(folder)
    files.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with files.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(data)
    return f"{folder}/{name}"


MANIFEST = "path string, size long, members long"


def manifest_of(written: DataFrame, name: str) -> Table:
    """Runs the writing tasks; their files are listed in a table of one row a file."""
    return Table(written.select("path", "size", "members"), name)


def listed(options: dict[str, str], suffix: str) -> list[tuple[str, int]]:
    """(path, size) of the archives of a manifest table, or of a folder."""
    if "manifest" in options:
        import pyarrow.dataset as ds

        files, path = place(options["manifest"])
        rows = ds.dataset(path, format="parquet", filesystem=files, exclude_invalid_files=True).to_table(columns=["path", "size"])
        return sorted(zip(rows["path"].to_pylist(), rows["size"].to_pylist()))
    from pyarrow import fs

    files, path = place(options["path"])
    found = files.get_file_info(fs.FileSelector(path, recursive=True))
    scheme = "file://" if isinstance(files, fs.LocalFileSystem) else options["path"].partition("://")[0] + "://"
    return sorted((scheme + f.path, f.size) for f in found if f.is_file and f.path.endswith(suffix))


@dataclass(frozen=True)
class Range:
    path: str
    start: int
    end: int
    size: int


@dataclass
class Ranges(InputPartition):
    items: list[Range]


def ranges(archives: list[tuple[str, int]], each: int, tasks: int = 64, most: int = 128 << 20) -> list[Ranges]:
    """Ranges of the archives' bytes, in partitions: up to ``most`` bytes of ranges each, less where the archives would
    make fewer than so many tasks, so that partitions grow with the input before their number does. Of no archives, one
    empty partition, as Spark wants one."""
    pack = max(each, min(most, sum(size for _, size in archives) // tasks))
    out, held = [Ranges([])], 0
    for p, size in archives:
        for a in range(0, size, each):
            one = Range(p, a, min(size, a + each), size)
            if held + one.end - a > pack and out[-1].items:
                out.append(Ranges([]))
                held = 0
            out[-1].items.append(one)
            held += one.end - a
    return out
