"""The registered queries and the pipeline over small tables, held against slow versions of their contracts."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from quillstream.llm import bpe, registry, secrets
from quillstream.llm.queries import _ranks
from tests.llm.conftest import prose
from tests.llm.test_large_operators import slow_components, slow_dedup, slow_pages, slow_print
from tests.llm.test_small_operators import sha, slow_base, slow_contamination

Q = registry.queries()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, corpus):
    rng = random.Random(9)
    folder = str(tmp_path_factory.mktemp("tables"))
    items = [(i, prose(rng, 30)) for i in range(8)] + [(10, "tiny item"), (11, None)]
    docs = [r for r in corpus if r[0] is not None and r[0] not in (5, 7, 100)]
    docs += [(600, f"x {items[0][1]} y {items[1][1]}"), (601, items[2][1].upper()), (602, f"password = {'s3cr3t' * 3} and AKIA{'Q' * 16} and {'0af1' * 8}")]
    labels = []
    for i in range(300):
        bad = i % 3 == 0
        words = prose(rng, 40).split()
        if bad:
            words[7:7] = ["numpty", "grumbleface"]
        docs.append((1000 + i, " ".join(words)))
        labels.append((1000 + i, 1, int(bad)))
    pages = [(i, f"u{i}", prose(rng, rng.randrange(1, 50))) for i in range(20)] + [(30, "u", "same"), (31, None, "same"), (32, "u", None), (33, "u", "")]

    def put(name, rows, shape):
        spark.createDataFrame(rows, shape).write.parquet(f"{folder}/{name}.parquet")

    put("documents", [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in docs], DOCS)
    put("benchmark", items, "item_id long, text string")
    put("labels", labels, "doc_id long, quality int, toxic int")
    put("pages", pages, "page_id long, url string, html string")
    return folder, docs, items, {i: x for i, _, x in labels}, pages


def got(spark, tables, name, *columns):
    return Counter(tuple(r[c] for c in columns) for r in Q[name](spark, tables[0]).collect())


def test_op3(spark, tables):
    want = Counter({(i, n, g, sha(k.encode())): c for (i, n, g, k), c in slow_dedup(tables[1], 20).items()})
    assert got(spark, tables, "op3_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_op4(spark, tables):
    want = slow_components([(i, slow_print(t)) for i, t in tables[1]])
    assert got(spark, tables, "op4_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == want


def test_op5(spark, tables):
    _, docs, items, *_ = tables
    want = Counter()
    for i, t in docs:
        n, h, f = slow_contamination(t, items)
        want[(i, n, h, len(f), sha(",".join(f).encode()), len(f) >= 2)] += 1
    assert got(spark, tables, "op5_benchmark_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


def slow_bpe(rows):
    plain, out = bpe.codec(bpe.Settings(_ranks())).fast, Counter()
    for i, t in rows:
        ids = plain.encode_ordinary(t or "")
        out[(i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode()))] += 1
    return out


def test_op6(spark, tables):
    assert got(spark, tables, "op6_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == slow_bpe(tables[1])


def test_op7(spark, tables):
    _, docs, _, truth, _ = tables
    out = Q["op7_toxicity"](spark, tables[0]).collect()
    assert len(out) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_op8(spark, tables):
    want = Counter()
    for i, t in tables[1]:
        found = slow_base(t)
        n = [sum(k == j for _, k, _ in found) for j in range(3)]
        want[(i, *n, sha(",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in found).encode()))] += 1
    assert got(spark, tables, "op8_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want


def test_op9(spark, tables):
    want = Counter()
    for i, t in tables[1]:
        data = (t or "").encode()
        full = data + b"\xff" * (-len(data) % 576 or (0 if data else 576))
        want[(i, len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))] += 1
    assert got(spark, tables, "op9_media_columns", "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == want


def test_op10(spark, tables):
    assert got(spark, tables, "op10_warc", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == slow_pages(tables[4])


def test_pipeline(spark, tables):
    """Stage by stage, each from its predecessor's rows; the classifier's decisions are taken from its own scores."""
    folder, docs, items, truth, _ = tables
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "secrets", "bpe"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, folder)
        kept[name] = now.collect()
        assert name == "bpe" or now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = spark.createDataFrame(kept[name], now.schema)
    rows = {n: [(r.doc_id, r.text) for r in kept[n]] for n in names[:-1]}
    bad = {r.doc_id for r in Q["op7_toxicity"](spark, folder).collect() if r.predicted}
    assert Counter(rows["toxicity"]) == Counter(r for r in docs if r[0] not in bad)
    same = slow_components([(i, slow_print(t)) for i, t in rows["toxicity"]])
    first = {i for i, _, c in same if i == c}
    assert Counter(rows["near_dedup"]) == Counter(r for r in rows["toxicity"] if r[0] in first)
    full = [(i, t) for i, t in items if len((t or "").split()) >= 8]
    clean = [r for r in rows["near_dedup"] if not slow_contamination(r[1], full)[2]]
    assert Counter(rows["decontamination"]) == Counter(clean)
    gone = {i for i, _ in rows["near_dedup"]} - {i for i, _ in clean}
    assert gone == {600, 601} and len(slow_contamination(dict(docs)[601], items)[2]) == 1  # one item is enough
    assert Counter(rows["secrets"]) == Counter((i, secrets.redact(t)) for i, t in clean)
    assert not any(slow_base(t) for _, t in rows["secrets"])
    whole = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == slow_bpe(rows["secrets"]) == Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in kept["bpe"])
