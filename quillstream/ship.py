"""Ships this package to the Python workers, which may not have it on their path, and bounds what they take at once."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: A batch of rows, which a worker holds in several forms.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "400", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
_ROOT = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once for each Spark context, and sets the session's batches."""
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    sc = spark.sparkContext
    if getattr(sc, "_quillstream_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="quillstream-")) / "quillstream.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(_ROOT.rglob("*.py")):
            z.write(file, str(file.relative_to(_ROOT.parent)))
    sc.addPyFile(str(target))
    sc._quillstream_shipped = True
