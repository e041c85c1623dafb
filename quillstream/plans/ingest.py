"""The ingestion plan: files to a chunk index, with a status for each document.

Everything before the index is row-wise, so nothing is shuffled until the status counts and the upsert.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.text import basename, extension, token_count
from ..operators import chunking, embed, index, metadata, parse, pii


def documents(files: DataFrame, meta: DataFrame | None = None, s: Settings = Settings(), analyzer: Callable | None = None) -> DataFrame:
    """Parsed documents with their metadata. files: file_path, content, last_modified, and source_type and source_url
    unless meta has them: (file_path, metadata map<string, string>), whose values win where they are not empty."""
    rows = files.withColumn("file_name", basename(F.col("file_path")))
    for c in ("source_type", "source_url"):
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("string"))
    rows = rows.withColumn("page_number", F.lit(None).cast("int"))
    if meta is not None:
        rows = rows.join(meta.select("file_path", F.col("metadata").alias("_m")), "file_path", "left")
        for c in ("source_type", "source_url", "last_modified"):
            rows = rows.withColumn(c, metadata.prefer(F.try_element_at("_m", F.lit(c)), F.col(c)))
        rows = rows.withColumn("page_number", F.coalesce(F.try_element_at("_m", F.lit("page_number")).try_cast("int"), "page_number")).drop("_m")
    rows = rows.withColumn("ext", extension(F.col("file_name")))
    parsed = parse.parse(rows, analyzer)
    labelled = F.transform(F.filter(F.coalesce("pages", F.array().cast(parse.PAGE)), lambda p: chunking.page_label(p.page, p.text, p.tables).isNotNull()), lambda p: chunking.page_label(p.page, p.text, p.tables))
    return parsed.withColumn("pages", F.transform(labelled, lambda t: F.struct(t.alias("label"), token_count(t).alias("tokens"))))


def scanned(docs: DataFrame, s: Settings = Settings(), entities=None, service=None) -> DataFrame:
    """Redacted chunks of the documents that pass the gates. entities(chunks) may give another recogniser's column, or a
    service may find them."""
    ready = docs.where(metadata.skip_reason(F.col("source_type"), F.col("source_url")).isNull() & F.col("parse_error").isNull())
    cut = chunking.chunk(ready, s)
    return pii.scan(cut, s, entities=entities(cut) if entities else None, service=service)


def chunks(docs: DataFrame, s: Settings = Settings(), model=None, entities=None, service=None) -> DataFrame:
    """Redacted and embedded chunks. Under the halt policy no text of a document that could not be scanned is embedded."""
    found = scanned(docs, s, entities, service)
    plain = entities is None and service is None  # the rules do not fail
    return embed.embed(found, model or embed.HashModel(s.dimensions), s) if plain else embedded(found, s, model)


def embedded(found: DataFrame, s: Settings = Settings(), model=None) -> DataFrame:
    """Scanned chunks with vectors, under the policy."""
    return embed.embed(pii.apply_policy(found, s), model or embed.HashModel(s.dimensions), s)


def status(docs: DataFrame, made: DataFrame, halted: DataFrame | None = None) -> DataFrame:
    """One row a document: status, stage, reason and counts. halted: (file_path) of documents that could not be scanned.

    Documents whose chunks all lack vectors are errors of the embed stage, and those with some are partial.
    """
    counts = metadata.summary(made)
    rows = docs.select("file_path", "file_name", "source_type", "source_url", "full_text", "parse_error").join(counts, "file_path", "left").withColumn("n_chunks", F.col("chunks_created"))
    gated = metadata.gate(rows)
    bad = F.lit(False)
    if halted is not None:
        gated = gated.join(halted.select("file_path", F.lit(True).alias("_bad")).distinct(), "file_path", "left")
        bad = F.coalesce("_bad", F.lit(False))
    none = (F.col("status") == "success") & (F.col("chunks_indexed") == 0)
    some = (F.col("status") == "success") & (F.col("chunks_skipped") > 0)
    return gated.select(
        F.when(bad | none, "error").when(some, "partial").otherwise(F.col("status")).alias("status"), F.when(bad, "pii_scan").when(none, "embed").otherwise(F.col("stage")).alias("stage"),
        F.when(bad, "not scanned").otherwise(F.col("reason")).alias("reason"), "file_name", "file_path",
        F.length("full_text").cast("long").alias("chars_extracted"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("chunks_created", "pii_chunks_redacted", "chunks_indexed", "chunks_skipped")),
    )


def letters(failed: DataFrame) -> DataFrame:
    """(file_path, stage, reason) as error records."""
    return failed.select(F.col("file_path").alias("blob_path"), F.concat_ws(": ", "stage", "reason").alias("error"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"))


def dead_letters(found: DataFrame) -> DataFrame:
    """Documents that failed, as error records."""
    return letters(found.where("status = 'error'"))


def upsert(store: index.Store, made: DataFrame, batch: int) -> None:
    """Replaces the documents of made in the store."""
    store.put(made, batch)
