"""The training-data operators as queries with their contracts' columns, and the corpus pipeline's stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, media, secrets, sharding, simhash, substring, toxicity, warc
from .common import prepare, read_table


def _ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op2_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(read_table(spark, sf_dir, "documents"), digest=True)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), bpe.Settings(_ranks()), digest=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _is(kind: str):
    return lambda x: x.kind == kind


def _joined(kinds: tuple[str, ...] | None):
    def of(found):
        kept = found if kinds is None else F.filter(found, lambda x: x.kind.isin(*kinds))
        return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")

    return of


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    prepare(spark)
    found = docs.select("doc_id", secrets.scan(F.col("text")).alias("found"))
    counts = [F.size(F.filter("found", _is(k))).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(secrets.BASE)(F.col("found")), 256).alias("base_sha256"), _joined(None)(F.col("found")).alias("spans"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.media(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages"))


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model, F.col("text")) < 0.5)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a full window of any benchmark item go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by labels; no document goes. n_chars follows the text."""
    prepare(spark)
    out = docs.withColumn("text", secrets.redacted(F.col("text")))
    return out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the decoded bytes."""
    return bpe.encode(docs, bpe.Settings(_ranks()), digest=True)


STAGES = [
    ("toxicity", stage_toxicity),
    ("near_dedup", stage_near_dedup),
    ("decontamination", stage_decontamination),
    ("secrets", stage_secrets),
    ("bpe", stage_bpe),
]
