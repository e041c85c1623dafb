"""Text, path and key expressions. All are built-in, so scans keep their pushdown and stages their codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ROOTS

_BLANK = r"[\p{IsWhite_Space}\x1c-\x1f]"
#: A token: a run of letters, up to three digits, or a run of other signs. An approximation of a real vocabulary's
#: count, generally below it; it adds up over texts joined by white space.
TOKEN = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]+"


def strip(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, rf"\A{_BLANK}+|{_BLANK}+\z", "")


def is_blank(text: Column) -> Column:
    """Null, empty, or white space only."""
    return F.coalesce(F.length(strip(text)) == 0, F.lit(True))


def token_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1))).cast("long"), F.lit(0).cast("long"))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)([^/]*)\z", 1)


def extension(name: Column) -> Column:
    """Lower-case, with its dot; leading dots of a name begin no extension."""
    return F.lower(F.regexp_extract(name, r"(?s)\A.*[^.].*(\.[^.]*)\z", 1))


def chunk_id(path: Column, index: Column) -> Column:
    """URL-safe base64 of path and index, without padding."""
    coded = F.base64(F.encode(F.concat(F.coalesce(path, F.lit("unknown")), F.lit("_"), index.cast("string")), "UTF-8"))
    return F.translate(F.translate(coded, "\r\n=", ""), "+/", "-_")


def breadcrumb(path: Column) -> Column:
    """The path's parts joined by ' > ', without known leading roots; of roots alone, the path as it is."""
    parts = F.split(F.regexp_replace(F.translate(path, "\\", "/"), r"\A/+|/+\z", ""), "/", -1)
    first = F.array_min(F.transform(parts, lambda p, i: F.when(~F.lower(p).isin(*ROOTS), i)))
    return F.when(F.coalesce(path, F.lit("")) == "", "").otherwise(F.coalesce(F.array_join(F.slice(parts, first + 1, F.size(parts)), " > "), path))


def page_number(content: Column, known: Column | None = None) -> Column:
    """A known number that is not 0, else that of a leading page label."""
    label = F.regexp_extract(content, r"\A\[Page\s+([0-9]+)\]", 1).try_cast("int")
    return label if known is None else F.coalesce(F.nullif(known.try_cast("int"), F.lit(0)), label)


def decode_text(content: Column) -> Column:
    """UTF-8, or Latin-1 where that is malformed."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def decode_lossy(content: Column) -> Column:
    """UTF-8, with U+FFFD for malformed bytes."""
    return F.make_valid_utf8(content.cast("string"))


def utc_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
