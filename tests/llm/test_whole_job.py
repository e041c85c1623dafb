"""Rows, ranks and texts that an operator once left out, at sizes or with keys that other tests do not have."""

import base64
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream.llm import secrets, sharding, simhash, substring, toxicity, words
from tests.llm.conftest import prose
from tests.llm.test_large_operators import slow_components, slow_dedup, slow_print
from tests.llm.test_small_operators import RSA


@pytest.mark.parametrize("bits", [4, 5])
def test_quantiles_of_many_rows_are_exact(spark, bits):
    """The cell of a size follows from exact quantiles, also beyond 10,000 rows."""
    n, top = 60_000, 1 << bits
    size = F.pmod(F.xxhash64("id"), F.lit(3500)).cast("int")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), size).alias("text")).repartition(7)
    sizes = sorted(r[0] for r in docs.select(F.length("text")).collect())
    cuts = [sizes[-(-i * n // top) - 1] for i in range(1, top)]
    got = {(r.b, r.curve) for r in sharding.shard(docs, sharding.Settings(bits=bits, strings=())).select((F.col("size") - 8).alias("b"), "curve").distinct().collect()}
    place = {b: sum(b > c for c in cuts) for b, _ in got}
    assert len(got) == len(place) and len({(c, place[b]) for b, c in got}) == len({c for _, c in got}) == len(set(place.values()))


def test_one_row_of_each_component(spark, make_docs, corpus):
    """Repeated rows, and rows without an id, are copies as any other."""
    base = " ".join(f"w{i}" for i in range(300))
    rows = [*corpus, *[(None, base)] * 4, *((None, f"{base} more{i}") for i in range(5)), *[(800, "one two three four")] * 3, (801, "five six seven"), (801, "one two three four"), (-3, "nine ten"), (None, "nine ten")]
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(make_docs(rows)).collect()]
    prints = [(n, slow_print(t)) for n, (_, t) in enumerate(rows)]  # components by the place of a row: each is one
    groups = {}
    for n, _, c in slow_components(prints):
        groups.setdefault(c, []).append(rows[n])
    key = lambda i: -(1 << 63) if i is None else i
    assert len(kept) == len(groups) < len(rows)
    for members in groups.values():
        mine = [r for r in kept if r in members]
        assert len(mine) == 1 and key(mine[0][0]) == min(key(i) for i, _ in members)


@pytest.mark.parametrize("stretch", [6 << 20, 3000])
def test_many_texts_under_one_id(spark, make_docs, stretch):
    """Texts of one id are told apart, however many: some repeat a passage, some are shorter, some are copies."""
    rng = random.Random(4)
    passage = prose(rng, 40)
    rows = [(None, f"{prose(rng, 20 + i % 90, 4000)} {passage if i % 2 else ''}") for i in range(900)]
    rows += [(None, prose(rng, rng.randrange(20, 30), 4000)) for _ in range(600)] + rows[:30] * 3 + [(1, passage), (None, None)]
    docs = make_docs(rows).repartition(3)
    out = substring.dedup(docs, substring.Settings(stretch=stretch)).collect()
    want = slow_dedup(rows, 20)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == want
    assert substring.dedup(docs).columns == ["doc_id", "n_words", "n_removed", "kept"]


def test_a_repeated_id_is_sampled_once(spark, make_docs):
    rows = [(i, f"text {i}") for i in range(20)] + [(7, f"other text {i}") for i in range(300)] + [(7, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    docs = make_docs(rows)
    got = [(r._id, r.label, r.text) for n in (1, 9) for r in toxicity.sample(docs.repartition(n), labels, toxicity.Settings(folds=99991), "doc_id", "text", "toxic").collect()]
    least = docs.where("doc_id = 7").orderBy(F.xxhash64("text")).first().text
    assert sorted(got, key=str) == sorted(2 * [(i, i % 2, least if i == 7 else f"text {i}") for i in range(20)], key=str)


@pytest.mark.parametrize("width", [20, 39, 64])
def test_private_keys_of_any_line_width(width):
    body = "\n".join(re.findall(f".{{1,{width}}}", base64.b64encode(RSA).decode()))
    key = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
    assert (4, 4 + len(key), "pem") in secrets.spans(f"key {key} end")
    assert secrets.redact(f"key {key} end") == "key [REDACTED:pem] end"
    assert secrets.spans("-----BEGIN PRIVATE KEY-----\nnot a key\n-----END PRIVATE KEY-----") == []


@pytest.mark.parametrize("fan", [2, 3])
def test_levels_of_dealing(spark, make_docs, corpus, fan):
    """More buckets than a level deals, and few entries settled together: as brute force says."""
    s = substring.Settings(stretch=3000, bucket_bytes=2500, fan=fan, entries=300)
    docs = make_docs(corpus)
    assert substring._width(s, substring.buckets_for(docs.select("text"), s.bucket_bytes)) > 1
    out = substring.dedup(docs, s).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == slow_dedup(corpus, 20)


def test_a_line_of_every_document(spark, make_docs):
    """What repeats inside a stretch is settled there: a common line sends a bucket one entry for each stretch."""
    rng = random.Random(12)
    line = prose(rng, 25, 5000)
    rows = [(i, f"{prose(rng, i % 7, 5000)} {line} {prose(rng, 30, 5000)}") for i in range(400)]
    out = substring.dedup(make_docs(rows).repartition(3), substring.Settings(stretch=4000)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == slow_dedup(rows, 20)
    kind = substring._Blocks(8)
    n = 1000
    own = np.arange(n) % 10 == 0
    e = {"value": np.full(n, 7 << 30, np.uint64), "state": own.astype(np.uint8), "ref": (np.cumsum(own) - 1).astype(np.int32)}
    e |= {c: np.arange(n)[own].astype(t) for c, t in kind.found}
    left, found = kind.settle(e)
    assert left["value"].tolist() == [7 << 30] and left["state"].tolist() == [2] and found["k"].tolist() == list(range(0, n, 10))


def test_words_made_to_collide(spark, make_docs):
    """Words that defeat a polynomial modulo 2**64 are told apart."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rows = [(1, " ".join(["x", a] * 10)), (2, " ".join(["x", b] * 10)), (3, " ".join(["x", a] * 10))]
    out = substring.dedup(make_docs(rows)).collect()
    assert {(r.doc_id, r.n_removed) for r in out} == {(1, 0), (2, 0), (3, 20)}
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abé", k=rng.randrange(1, 40))) for _ in range(200)).encode() for _ in range(5)]
    one, n = words.hash_words(texts, 2)
    small, m = words.hash_words(texts, 2, piece=50)
    flat = [w for t in texts for w in t.split()]
    assert n.tolist() == m.tolist() == [200] * 5 and all((x == y).all() for x, y in zip(one, small))
    for lane in one:
        assert len(dict(zip(flat, lane.tolist()))) == len(set(lane.tolist())) == len(set(zip(flat, lane.tolist())))


def test_texts_are_dealt_once(spark, make_docs, corpus):
    out = substring.dedup(make_docs(corpus))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "BroadcastExchange" not in plan
