"""Views that give plain tables the shapes of the ingestion domain: files, pages, notifications, workbooks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key, values):
    out = None
    for i, v in enumerate(values):
        out = F.when(key == i, v) if out is None else out.when(key == i, v)
    return out


def doc_files(documents: DataFrame) -> DataFrame:
    """documents with a path whose root and extension follow from doc_id."""
    root = _pick(F.col("doc_id") % 5, ["wiki/", "sharepoint/", "raw-documents/Wiki/", "", "Documents/"])
    ext = _pick(F.col("doc_id") % 7, [".md", ".txt", ".PDF", ".xlsx", ".docx", ".exe", ""])
    return documents.withColumn("path", F.concat(root, "lang", F.lit("/"), "source", F.lit("/doc_"), F.col("doc_id").cast("string"), ext))


def conv_pages(conversations: DataFrame) -> DataFrame:
    """A conversation is a document, a turn is a page."""
    return conversations.select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).cast("int").alias("page"), "text")


def notifications(events: DataFrame) -> DataFrame:
    """An event is a notification about a file; some are malformed, of other containers, folders or empty."""
    key = F.col("event_id")
    ext = F.when(key % 11 == 1, ".error.json").when(key % 11 == 2, "/").when(key % 11 == 3, ".exe").when(key % 11 == 4, ".PDF").otherwise(".txt")
    url = F.concat(F.when(key % 11 == 0, "https://store/other/").otherwise("https://store/raw-documents/"), "event_type", F.lit("/u"), F.col("user_id").cast("string"), F.lit("/f"), key.cast("string"), ext)
    return events.select("event_id", url.alias("url"), F.when(key % 13 != 0, F.floor(F.abs("value")).cast("long")).alias("content_length"))


def messages(events: DataFrame) -> DataFrame:
    """Notifications as queue messages: bare, under data, or two in a list."""
    one = F.concat(F.lit('{"url": "'), "url", F.lit('", "contentLength": '), F.coalesce(F.col("content_length").cast("string"), F.lit("null")), F.lit("}"))
    wrapped = F.concat(F.lit('{"data": '), one, F.lit("}"))
    key = F.col("event_id") % 3
    return notifications(events).select("event_id", F.when(key == 0, one).when(key == 1, wrapped).otherwise(F.concat(F.lit(" ["), one, F.lit(", "), wrapped, F.lit("]"))).alias("value"))


def lines(documents: DataFrame) -> DataFrame:
    """documents with their lines as an array."""
    return documents.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))


def workbooks(documents: DataFrame) -> DataFrame:
    """A document as the text of a workbook with three sheets, one of them empty."""
    text = F.concat(F.lit("junk\nSheet: "), "lang", F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("\nSheet: none\nSheet:  "), "source", F.lit(" \n"), F.substring(F.coalesce("text", F.lit("")), 1, 50))
    return documents.select("doc_id", text.alias("text"))
