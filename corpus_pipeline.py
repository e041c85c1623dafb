"""The corpus pipeline: toxicity, SimHash near-dedup, benchmark decontamination, secret scans, byte-level BPE.

Counted as part of quillstream.llm. Each stage works on all that its predecessor kept, written as Parquet and read
again. SQL cannot express the classifier, the fingerprints or the tokenizer, so ORACLE_SQL is None and
tests/llm/test_queries.py holds the result against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstream.llm.common import materialize
from quillstream.llm.queries import STAGES

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
