"""Embeddings: input rules, batches, and a deterministic local model."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import folds
from ..functions.text import TOKEN, token_count
from ..ship import ship
from .remote import Quota, Retry, call

EMPTY = "[empty]"


def sanitise(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(EMPTY))


def batches(sizes: Column, s: Settings = Settings()) -> Column:
    """Runs of a document's chunks that go to the model together."""
    return folds.pack(sizes, s.embed_batch_tokens, s.embed_batch, alone=True)


@lru_cache(maxsize=1 << 16)
def _hashed(word: str, dimensions: int) -> tuple[int, int]:
    h = hashlib.blake2b(word.encode(), digest_size=8).digest()
    return int.from_bytes(h[:6], "little") % dimensions, 1 if h[7] & 1 else -1


def hash_vector(text: str, dimensions: int) -> np.ndarray:
    """A unit vector from hashed words: equal texts get equal vectors, texts that share words are near."""
    # sums of whole numbers, exact in any order
    sums = [0.0] * dimensions
    for word in text.lower().split():
        place, sign = _hashed(word, dimensions)
        sums[place] += sign
    out = np.array(sums)
    norm = np.sqrt(out.dot(out))
    return (out / norm if norm else out).astype(np.float32)


class HashModel:
    """The default model. A model is a picklable object with embed(texts) -> list of (index, vector)."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def embed(self, texts: list[str]) -> list[tuple[int, list[float]]]:
        return [(i, hash_vector(t, self.dimensions)) for i, t in enumerate(texts)]


class Service:
    """A remote model under a quota: waits before a batch as the quota says, tries again after errors that may pass and
    after bad answers, and learns the quota from the answers' headers.

    client(texts) -> (list of (index, vector), headers). callers: how many tasks call at once, which Spark knows.
    """

    def __init__(self, client, callers: int = 1, retry: Retry = Retry(every_error=True), sleep=time.sleep, size=len):
        self.client, self.retry, self.sleep, self.size, self.quota = client, retry, sleep, size, Quota(callers=callers)

    def embed(self, texts: list[str]) -> list[tuple[int, list[float]]]:
        n = sum(map(self.size, texts))

        def ask():
            wait = self.quota.throttle(n)
            if wait:
                self.sleep(wait)
            found, headers = self.client(texts)
            self.quota.read(headers)
            return answered(found, len(texts))

        began = time.monotonic()
        out = call(ask, self.retry, self.sleep)
        left = self.quota.pace(n) - (time.monotonic() - began)
        if left > 0:
            self.sleep(left)
        return out


def embed(chunks: DataFrame, model=None, s: Settings = Settings(), text_col: str = "chunk_content") -> DataFrame:
    """Adds content_vector, null where the model failed for a batch. Texts are sanitised and cut first.

    Batches are made of the rows of an Arrow batch, so which texts go together also depends on its size, but no vector
    does. model has embed(texts) -> list of (index, vector), as HashModel and Service have.
    """
    model = model or HashModel(s.dimensions)
    ship(chunks.sparkSession)
    most, limit = s.embed_batch, s.embed_batch_tokens

    @F.pandas_udf("struct<cut: string, vector: array<float>>")
    def run(batches_: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        import regex

        found = regex.compile(TOKEN)
        for texts, tokens in batches_:
            cuts = [t[: [m.end() for _, m in zip(range(s.embed_input_tokens), found.finditer(t))][-1]] if n > s.embed_input_tokens else None for t, n in zip(texts, tokens)]
            inputs = [t if c is None else c for t, c in zip(texts, cuts)]
            out: list = [None] * len(inputs)
            for a, b in spans([min(n, s.embed_input_tokens) for n in tokens.tolist()], limit, most):
                try:
                    for i, v in sorted(answered(model.embed(inputs[a:b]), b - a)):
                        out[a + i] = v
                except Exception:  # noqa: BLE001 - a batch that fails for good leaves null vectors
                    out[a:b] = [None] * (b - a)
            yield pd.DataFrame({"cut": pd.Series(cuts, dtype="object"), "vector": pd.Series(out, dtype="object")})

    # tokens are counted once, and one worker cuts and embeds; nondeterministic, so that the optimizer does not copy the call
    rows = chunks.withColumn(text_col, sanitise(F.col(text_col)))
    rows = rows.withColumn("_e", run.asNondeterministic()(F.col(text_col), token_count(F.col(text_col))))
    return rows.withColumns({text_col: F.coalesce("_e.cut", text_col), "content_vector": F.col("_e.vector")}).drop("_e")


def answered(vectors: list[tuple[int, list[float]]], n: int) -> list[tuple[int, list[float]]]:
    if sorted(i for i, _ in vectors) != list(range(n)):
        raise ValueError(f"{n} texts, vectors of {[i for i, _ in vectors]}")
    return vectors


def spans(sizes: list[int], limit: int, most: int) -> Iterator[tuple[int, int]]:
    """What batches() makes, inside a worker."""
    at = total = 0
    for i, n in enumerate(sizes):
        if i > at and (n >= limit or total >= limit or total + n > limit or i - at >= most):
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)
