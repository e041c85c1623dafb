"""Storage notifications and the rules that admit a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ALLOWED_EXTENSIONS, Settings
from ..functions.text import basename, extension

_ONE = "struct<url: string, contentType: string, contentLength: bigint>"
_ITEM = "struct<url: string, contentType: string, contentLength: bigint, data: struct<url: string, contentType: string, contentLength: bigint>>"


def unwrap(messages: DataFrame, column: str = "value") -> DataFrame:
    """A row for each notification of each message: an object or a list, each bare or under ``data``.

    Items that are no objects give no row, and messages that are no JSON none with a url; malformed() has both.
    """
    text = F.ltrim(F.col(column))
    listed = F.when(text.startswith("["), F.from_json(text, f"array<{_ITEM}>")).otherwise(F.array(F.from_json(text, _ITEM)))
    rows = messages.withColumn("_item", F.explode(listed)).where(F.col("_item").isNotNull())
    fields = F.when(F.col("_item.data").isNotNull(), F.col("_item.data")).otherwise(F.struct("_item.url", "_item.contentType", "_item.contentLength"))
    return rows.withColumn("_one", fields).select(*messages.columns, F.col("_one.url").alias("url"), F.col("_one.contentType").alias("content_type"), F.col("_one.contentLength").alias("content_length"))


def malformed(messages: DataFrame, column: str = "value") -> DataFrame:
    """Messages that are no JSON, or hold an item without a url, with a reason."""
    text = F.ltrim(F.col(column))
    listed = F.when(text.startswith("["), F.from_json(text, f"array<{_ITEM}>")).otherwise(F.array(F.from_json(text, _ITEM)))
    none = listed.isNull() | F.exists(listed, lambda x: F.coalesce(x.data.url, x.url).isNull())
    return messages.where(F.col(column).isNull() | none).withColumn("reason", F.lit("malformed message"))


def blob_path(url: Column, container: str) -> Column:
    """What follows the first ``/container/``; null without one."""
    mark = f"/{container}/"
    at = F.instr(url, mark)
    return F.when(at > 0, F.substring(url, at + len(mark), F.length(url)))


def strip_container(name: Column, container: str) -> Column:
    return F.when(name.startswith(f"{container}/"), F.substring(name, F.lit(len(container) + 2), F.length(name))).otherwise(name)


def reject_reason(path: Column, length: Column, is_folder: Column | None = None) -> Column:
    """Null if admitted, else the first rule that rejects."""
    out = F.when(path.isNull(), "no_container")
    if is_folder is not None:
        out = out.when(F.coalesce(is_folder, F.lit(False)), "folder")
    return (
        out.when(path.endswith(".error.json"), "error_file").when(F.coalesce(length, F.lit(0)) == 0, "zero_bytes").when(path.endswith("/"), "folder")
        .when(~extension(basename(path)).isin(*ALLOWED_EXTENSIONS), "extension")
    )


def admit(notifications: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Adds blob_path and reject_reason to rows with url and content_length."""
    placed = notifications.withColumn("blob_path", blob_path(F.col("url"), s.raw_container))
    return placed.withColumn("reject_reason", reject_reason(F.col("blob_path"), F.col("content_length")))
