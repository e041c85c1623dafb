"""Metadata precedence, gates and document status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename, is_blank


def prefer(stored: Column, caller: Column, default: Column | None = None) -> Column:
    """A stored value that is not empty, else the caller's, else a default."""
    return F.coalesce(F.nullif(stored, F.lit("")), caller, *([] if default is None else [default]))


def merge_maps(caller: Column, stored: Column) -> Column:
    """caller's entries, overridden by stored ones that are not empty."""
    kept = F.map_filter(F.coalesce(stored, F.create_map().cast("map<string,string>")), lambda _, v: F.coalesce(v, F.lit("")) != "")
    known = F.coalesce(caller, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(known, lambda k, _: ~F.array_contains(F.map_keys(kept), k)), kept)


def skip_reason(source_type: Column, source_url: Column) -> Column:
    """Null if both required fields are there."""
    return F.when(F.coalesce(source_type, F.lit("")) == "", "missing_source_type").when(F.coalesce(source_url, F.lit("")) == "", "missing_source_url")


def gate(docs: DataFrame) -> DataFrame:
    """Adds status, stage and reason to docs with source_type, source_url, full_text, parse_error and n_chunks."""
    required = skip_reason(F.col("source_type"), F.col("source_url"))
    reason = F.coalesce(required, F.when(F.col("parse_error").isNotNull(), F.col("parse_error")), F.when(is_blank(F.col("full_text")), "no_text_extracted"), F.when(F.coalesce("n_chunks", F.lit(0)) == 0, "no_chunks_produced"))
    failed = required.isNull() & F.col("parse_error").isNotNull()
    return docs.withColumn("reason", reason).withColumn("stage", F.when(failed, "parse")).withColumn("status", F.when(failed, "error").when(F.col("reason").isNotNull(), "skipped").otherwise("success"))


def file_name(path: Column) -> Column:
    return basename(path)


def summary(chunks: DataFrame) -> DataFrame:
    """Per document: chunks created, redacted, indexed and skipped. chunks: file_path, pii_redacted, content_vector."""
    return chunks.groupBy("file_path").agg(
        F.count("*").alias("chunks_created"), F.count_if(F.col("pii_redacted")).alias("pii_chunks_redacted"),
        F.count_if(F.col("content_vector").isNotNull()).alias("chunks_indexed"), F.count_if(F.col("content_vector").isNull()).alias("chunks_skipped"),
    )
