"""Secret scans with structural confirmation.

Base kinds, leftmost and non-overlapping each: ``assign`` (a named value of 6 or more characters), ``access`` (key
ids of 20 or more) and ``hex`` (runs of 24 or more). The method adds kinds that are reported only if their decoded
bytes have the right structure: ``jwt`` (a token with a decodable signature whose header is JSON with a signing
algorithm), ``der`` (base64 or hex of an ASN.1 sequence that holds a private key's version and numbers and whose nested
lengths fit exactly), ``ssh`` (the container of private keys, whose length-prefixed fields fit) and ``pem`` (an armoured
private key whose body, after any header lines, decodes to such bytes; its line ends may be escaped as in JSON). Public keys and unsigned tokens are no secrets
and are not reported. A hex run of odd length is tried without its first and without its last digit.

Whole texts are scanned. A null text counts as empty: no spans. Spans are in code points, the end exclusive. A row is
judged on its own: repeated rows get equal results, an empty table none, and other columns are not looked at.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "jwt", "der", "ssh", "pem")
BASE = KINDS[:3]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_BIG_HEX = re.compile(r"[0-9A-Fa-f]{48,}")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])e[yw][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
_ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z ]*PRIVATE KEY)-----")
_HEADER = re.compile(r"\s*[A-Za-z-]+:")
#: Characters by what a run of them can be: d for digits and a-f, b for the rest of base64's.
_CLASS = bytes(100 if chr(c) in "0123456789abcdef" else 98 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz+/_-" else 32 for c in range(256))
_LONG = re.compile(rb"[db]{40}")


def unbase64(text: str) -> bytes | None:
    """Standard or URL-safe base64, padded or not."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """A DER length: its value and where the contents begin."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 0x80:
        return first, at + 1
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 1 + n > len(data) or data[at + 1] == 0:
        return None
    value = int.from_bytes(data[at + 1 : at + 1 + n], "big")
    return (value, at + 1 + n) if value >= 0x80 else None


def der_fields(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, stop) of the fields that fill data[at:end] exactly."""
    out = []
    while at < end:
        tag, found = data[at], _length(data, at + 1)
        if found is None or found[1] + found[0] > end:
            return None
        out.append((tag, found[1], found[1] + found[0]))
        at = found[1] + found[0]
    return out


def is_der_key(data: bytes) -> bool:
    """A private key: a sequence over the whole input, begun by a version, then at least three positive integers more
    (RSA, DSA), octets (EC), or an algorithm and octets (PKCS 8); or an algorithm with parameters and encrypted octets."""
    top = der_fields(data, 0, len(data)) if len(data) >= 24 and data[0] == 0x30 else None
    if not top or len(top) != 1:
        return False
    parts = der_fields(data, top[0][1], top[0][2])
    if not parts or len(parts) < 2:
        return False
    first, second = parts[0], parts[1]
    if first[0] == 0x02 and first[2] - first[1] == 1 and data[first[1]] in (0, 1):
        if second[0] == 0x02:
            return len(parts) >= 5 and all(t == 0x02 and b > a and data[a] < 0x80 for t, a, b in parts[1:5])
        if second[0] == 0x30:
            named = der_fields(data, second[1], second[2])
            return bool(named) and named[0][0] == 0x06 and len(parts) >= 3 and parts[2][0] == 0x04
        return second[0] == 0x04 and second[2] - second[1] >= 16
    named = der_fields(data, first[1], first[2]) if first[0] == 0x30 else None
    return bool(named) and len(named) == 2 and named[0][0] == 0x06 and named[1][0] == 0x30 and len(parts) == 2 and second[0] == 0x04


def is_ssh_key(data: bytes) -> bool:
    """A container of private keys: cipher, key derivation and its options, the number of keys, then each public key and
    the private part, as length-prefixed fields that fit."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    if not field() or not field() or field() is None:
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return 1 <= keys <= 16 and all(field() for _ in range(keys + 1))


def is_token(text: str) -> bool:
    """A compact token that is signed: a JSON header that names an algorithm other than none, and a signature of 16 bytes
    or more."""
    header, _, signature = (unbase64(x) for x in text.split("."))
    if not header or not header.lstrip().startswith(b"{") or len(signature or b"") < 16:
        return False
    try:
        fields = json.loads(header)
    except (ValueError, RecursionError):
        return False
    return isinstance(fields, dict) and isinstance(fields.get("alg"), str) and fields["alg"].lower() != "none"


def _confirmed(data: bytes | None) -> str | None:
    return None if not data else "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def armoured(text: str) -> Iterator[tuple[int, int]]:
    """Armoured private keys: a first line, header lines if any, a body, and the nearest last line, of the same label. Line ends
    may be written as a backslash and n, as in JSON. Each mark is looked at once, so time is in proportion to the text."""
    begun = None
    for m in _ARMOUR.finditer(text):
        if m[1] == "END" and begun and begun[2] == m[2]:
            lines = text[begun.end() : m.start()].replace("\\r", "").replace("\\n", "\n").split("\n")
            first = max((i + 1 for i, line in enumerate(lines) if ":" in line), default=0)
            if all(_HEADER.match(line) or not line.strip() for line in lines[:first]):
                body = unbase64("".join("".join(lines[first:]).split()))
                # an older armour says in its header lines that the body is encrypted, so only whole cipher blocks can be seen
                shut = any("ENCRYPTED" in line for line in lines[:first])
                if _confirmed(body) or shut and body and len(body) >= 64 and len(body) % 8 == 0:
                    yield begun.start(), m.end()
        begun = m if m[1] == "BEGIN" else None


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then by the order of KINDS."""
    if not text:
        return []
    out: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    runs = text.encode().translate(_CLASS)
    if b"d" * 24 in runs:
        out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:  # its lines may be shorter than any run
        out += [(a, b, "pem") for a, b in armoured(text)]
    if _LONG.search(runs):
        for m in _BASE64.finditer(text):
            kind = _confirmed(unbase64(m[0]))
            if kind:
                out.append((m.start(), m.end(), kind))
        for m in _BIG_HEX.finditer(text):
            odd = len(m[0]) % 2
            for cut in range(odd + 1):
                a, b = m.start() + (odd and cut), m.end() - (odd and 1 - cut)
                if kind := _confirmed(bytes.fromhex(text[a:b])):
                    out.append((a, b, kind))
    if "ey" in text or "ew" in text:
        out += [(m.start(), m.end(), "jwt") for m in _JWT.finditer(text) if is_token(m[0])]
    return sorted(set(out), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def redact(text: str | None) -> str | None:
    """The text with each stretch of overlapping spans replaced by a label of its first kind; no label reads as a secret."""
    found = spans(text)
    if not found:
        return text
    out, at = [], 0
    merged: list[list] = []
    for a, b, kind in found:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[at:a], f"[REDACTED:{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def scan(text: Column) -> Column:
    """array<struct<start, end, kind>> of a text column."""

    @F.pandas_udf("array<struct<start: long, end: long, kind: string>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"start": a, "end": b, "kind": k} for a, b, k in spans(t)] for t in texts])

    return find(text)


def redacted(text: Column) -> Column:
    """A text column with its secrets replaced by labels; null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([redact(t) for t in texts], dtype="object")

    return run(text)
