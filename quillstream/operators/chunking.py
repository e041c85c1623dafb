"""Chunks: recursive splitting, page packing, sheets and sections, and the chunk records.

Each operator works inside a document's row; chunks appear by posexplode, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import folds
from ..functions.text import TOKEN, breadcrumb, chunk_id, is_blank, page_number, strip, token_count
from ..ship import ship

#: What a text is split at, in order of preference. The plain list has no sentence end.
SENTENCES = ("\n\n", "\n", ". ", " ", "")
PLAIN = ("\n\n", "\n", " ", "")
#: White space is listed, as that of RE2, which Java's \s exceeds by the vertical tab.
_SHEET = r"(?md)^Sheet:[\t\n\f\r ]*(.+)$"


def counter() -> Callable[[str], int]:
    """The token counter of functions.text.token_count, for Python workers."""
    import regex

    found = regex.compile(TOKEN)
    return lambda text: len(found.findall(text))


def split_text(text: str, size: int, overlap: int, separators: tuple[str, ...], count: Callable[[str], int]) -> list[str]:
    """Pieces of at most size tokens that follow each other with up to overlap tokens in common.

    The text is cut at its first separator that occurs, each part keeping it in front; parts that are too large are
    cut by the later separators. Parts are then gathered greedily. Pieces are stripped, and empty ones left out. Only a
    single character of more than size tokens makes a larger piece.
    """
    at = next(i for i, s in enumerate(separators) if not s or s in text)
    sep, rest = separators[at], separators[at + 1 :]
    if sep:
        first, *more = text.split(sep)
        parts = [p for p in (first, *(sep + m for m in more)) if p]
    else:
        parts = list(text)
    out: list[str] = []
    held: list[tuple[str, int]] = []
    total = fresh = 0

    def close() -> None:
        piece = "".join(p for p, _ in held).strip()
        if piece:
            out.append(piece)

    for part in parts:
        n = count(part)
        if n > size and rest:
            if fresh:
                close()
            held, total, fresh = [], 0, 0
            out += split_text(part, size, overlap, rest, count)
            continue
        if held and total + n > size:
            if fresh:
                close()
            while held and (total > overlap or total + n > size):
                total -= held.pop(0)[1]
            fresh = 0
        held.append((part, n))
        total, fresh = total + n, fresh + 1
    if fresh:
        close()
    return out


def splitter(s: Settings, separators: tuple[str, ...] = PLAIN):
    """A column function: text to its pieces. Null and blank texts have none."""
    size, overlap = s.chunk_tokens, s.overlap_tokens

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter()
        for texts in batches:
            yield pd.Series([split_text(t, size, overlap, separators, count) if t and t.strip() else [] for t in texts], dtype="object")

    return run


def page_label(number: Column, text: Column, tables: Column | None = None) -> Column:
    """[Page n] and the page's text with its tables; null for a blank page."""
    whole = F.coalesce(text, F.lit(""))
    if tables is not None:
        whole = F.concat(whole, F.when(F.coalesce(tables, F.lit("")) != "", F.concat(F.lit("\n"), tables)).otherwise(""))
    return F.when(~is_blank(whole), F.concat(F.lit("[Page "), F.coalesce(number.cast("string"), F.lit("?")), F.lit("]\n"), strip(whole)))


def gather_pages(pages: DataFrame, keys: tuple[str, ...] = ("doc",)) -> DataFrame:
    """One row a document: its labelled pages in order. A page's tokens are counted once, before the shuffle."""
    rows = pages.withColumn("label", page_label(F.col("page"), F.col("text"))).where("label is not null").withColumn("tokens", token_count(F.col("label")))
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page", "label", "tokens"))).alias("pages"))


def pack_pages(docs: DataFrame, limit: int, pages: str = "pages") -> DataFrame:
    """Adds groups: runs of pages whose tokens together stay within the limit (a larger page is a run of its own)."""
    return docs.withColumn("groups", folds.pack(F.transform(pages, lambda p: p.tokens), limit))


def group_texts(pages: Column, groups: Column) -> Column:
    """The text of each group of pages."""
    return F.transform(groups, lambda g: F.array_join(F.transform(F.slice(pages, g.start, g.n), lambda p: p.label), "\n\n"))


def named_sheets(text: Column) -> Column:
    """array<struct<name, body>> of the sheets that a workbook's text names. Text before the first and empty sheets are left out."""
    names = F.regexp_extract_all(text, F.lit(_SHEET), F.lit(1))
    bodies = F.split(text, _SHEET, -1)
    # the arrays meet by zip_with, as an array that a lambda captures would be made again for each sheet
    both = F.zip_with(F.slice(bodies, 2, F.size(names)), names, lambda b, n: F.struct(strip(n).alias("name"), strip(b).alias("body")))
    return F.filter(both, lambda x: x.body != "")


def sheets(text: Column) -> Column:
    """named_sheets, or if there are none the whole text as one that is named default."""
    found = named_sheets(text)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(F.lit("default").alias("name"), strip(text).alias("body"))))


def _counted(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.struct(t.alias("t"), token_count(t).alias("n")))


def chunk(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Chunk records of docs.

    docs: file_path, file_name, ext, full_text, sections (array<string>), pages (array<struct<page, label, tokens>>),
    source_url, source_type, last_modified, page_number. A strategy is chosen by extension; documents without text
    give no chunks. Index and total count over the whole document.
    """
    ship(docs.sparkSession)
    kind = strategy(F.col("ext"), s)
    text = F.coalesce("full_text", F.lit(""))
    rows = docs.withColumn("_kind", kind).where(~is_blank(text))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_groups", folds.pack(F.transform("pages", lambda p: p.tokens), s.chunk_tokens))
    paged = group_texts(F.col("pages"), F.col("_groups"))
    own = sheets(text)
    texts = (
        F.when(F.col("_kind") == "sheet_based", F.transform(own, lambda x: x.body))
        .when((F.col("_kind") == "header_based") & (F.size(F.coalesce("sections", none)) > 0), F.col("sections"))
        .when((F.col("_kind") == "semantic") & (F.size("_groups") > 0), paged)
        .otherwise(F.array(text))
    )
    names = F.when(F.col("_kind") == "sheet_based", F.transform(own, lambda x: x["name"])).otherwise(none)
    rows = rows.withColumn("_texts", _counted(texts)).withColumn("_names", names)
    size, overlap = s.chunk_tokens, s.overlap_tokens

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        count = counter()
        for texts, names, kinds in batches:
            out = []
            for t, n, k in zip(texts, names, kinds):
                seps = SENTENCES if k == "recursive" else PLAIN
                done = []
                for i, x in enumerate(t):
                    label = f"[Sheet: {n[i]}]\n" if k == "sheet_based" else ""
                    whole = x["n"] <= size and k == "semantic"
                    done += [label + p for p in ([x["t"]] if whole else split_text(x["t"], size, overlap, seps, count) if x["t"].strip() else [])]
                out.append(done)
            yield pd.Series(out, dtype="object")

    # nondeterministic, so that the optimizer neither copies nor moves the call
    rows = rows.withColumn("_pieces", cut.asNondeterministic()("_texts", "_names", "_kind"))
    cols = ["file_path", "file_name", "source_url", "source_type", "last_modified", "page_number"]
    flat = rows.select(*cols, F.size("_pieces").alias("total_chunks"), F.posexplode("_pieces").alias("chunk_index", "chunk_content"))
    return records(flat)


def records(flat: DataFrame) -> DataFrame:
    """The fixed columns of chunks. flat: chunk_index, total_chunks, chunk_content and the document's columns."""
    return flat.select(
        chunk_id(F.col("file_path"), F.col("chunk_index")).alias("id"), "chunk_content", F.coalesce("file_name", F.lit("")).alias("document_title"),
        F.coalesce("source_url", F.lit("")).alias("source_url"), F.coalesce("source_type", F.lit("")).alias("source_type"), F.coalesce("file_name", F.lit("")).alias("file_name"),
        breadcrumb(F.col("file_path")).alias("breadcrumb"), F.col("chunk_index").cast("int").alias("chunk_index"), F.col("total_chunks").cast("int").alias("total_chunks"),
        page_number(F.col("chunk_content"), F.col("page_number")).alias("page_number"), F.col("last_modified").try_cast("timestamp").alias("last_modified"),
        F.current_timestamp().alias("ingested_at"), F.lit(False).alias("pii_redacted"), "file_path",
    )


def strategy(ext: Column, s: Settings = Settings()) -> Column:
    """The name of the strategy for an extension."""
    known = s.strategies
    e = F.lower(ext)
    return (
        F.when(e.isin(".md", ".markdown"), known["markdown"]).when(e.isin(".xlsx", ".xls", ".xlsm"), known["xlsx"])
        .when(e == ".pdf", known["pdf"]).otherwise(known["default"])
    )
