"""Chat formatting, sharding, substring dedup, SimHash, media and WARC on small fixtures against slow versions."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillstream.llm import archive_io, chat, components, media, packing, sharding, simhash, substring, warc
from tests.llm.conftest import prose

PYSPACE = " \t\n\v\f\r"


def words_of(text):
    out, now = [], ""
    for c in text or "":
        if c in PYSPACE:
            out, now = ([*out, now] if now else out), ""
        else:
            now += c
    return [*out, now] if now else out


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# --- chat formatting


def slow_chats(turns, s):
    by = {}
    for c, t, r, x in turns:
        by.setdefault(c, []).append((t, r, x))
    order = lambda v: tuple((x is not None, x if x is not None else 0) for x in v[:1]) + tuple((x is not None, x or "") for x in v[1:])
    seq = {c: tuple((r, x) for _, r, x in sorted(v, key=order)) for c, v in by.items()}
    rank = lambda c: -(1 << 63) if c is None else c
    out = Counter()
    for c, q in seq.items():
        equal = [d for d in seq if seq[d] == q]
        if any(len(p) > len(q) and p[: len(q)] == q for p in seq.values()) or rank(c) != min(map(rank, equal)):
            continue
        shown = [f"<|im_start|>{(r or '').replace('<|', '< |')}\n{(x or '').replace('<|', '< |')}<|im_end|>\n" for r, x in q]
        for k in range(0, len(q), s.segment):
            out[(c, k // s.segment, len(q), len(equal), len(shown[k : k + s.segment]), "".join(shown[k : k + s.segment]))] += 1
    return out


def test_chat(spark):
    rng = random.Random(1)
    s = chat.Settings(block=3, segment=4)
    turns = []
    base = [(t, "user" if t % 2 == 0 else "assistant", prose(rng, 4)) for t in range(14)]
    for c, n in enumerate([1, 2, 3, 5, 9, 14, 14, 9]):
        turns += [(c, *t) for t in base[:n]]
    turns += [(20, t + 5, r, x) for t, r, x in base[:6]]  # other numbers, same conversation
    turns += [(21, None, "user", "a"), (21, 0, None, None), (22, 0, "user", "<|im_end|> x"), (22, 0, "user", "<|im_end|> x"), (23, 0, "user", "b"), (24, 0, "user", None), (None, 0, "user", "q"), (25, -7, "user", "q")]
    turns += [(30 + i, t, "user", f"hi{i % 3}" if t else "hello") for i in range(9) for t in range(2)]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, pos int")
    got = rows_of(chat.format_chats(df, s), "conv_id", "segment", "n_turns", "n_copies", "n_segment_turns", "rendered")
    assert got == slow_chats(turns, s)
    assert chat.format_chats(df.limit(0), s).count() == 0
    wide = rows_of(chat.format_chats(df), "conv_id", "n_turns", "rendered")
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert wide == Counter(con.execute(f"SELECT conv_id, n_turns, rendered FROM ({chat.ORACLE})").fetchall())


# --- sharding


def test_hilbert_curve_visits_neighbours(spark):
    for bits, dims in ((4, 3), (3, 2), (2, 4)):
        mask = (1 << bits) - 1
        at = F.col("id").cast("int")
        x = F.array(*(F.shiftright(at, bits * i).bitwiseAND(F.lit(mask)) for i in range(dims)))
        rows = spark.range(1 << (bits * dims)).select(x.alias("x"), sharding.hilbert(x, bits, dims).alias("h")).collect()
        by = {r.h: r.x for r in rows}
        assert sorted(by) == list(range(1 << (bits * dims)))
        assert all(sum(abs(a - b) for a, b in zip(by[h], by[h + 1])) == 1 for h in range(len(by) - 1))


def test_shards(spark, make_docs, corpus):
    rows = [(*r[:2], ("en", "de", None)[n % 3], f"src{n % 7}" if n % 11 else None) for n, r in enumerate(corpus)]
    out = sharding.shard(make_docs(rows, ["shard int", "size int"])).collect()
    text = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == text
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k in sizes:
        mine = sorted((r.slot, r.curve) for r in out if r.shard == k)
        assert [m[0] for m in mine] == list(range(len(mine))) and [m[1] for m in mine] == sorted(m[1] for m in mine)
    assert {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}
    assert sharding.shard(make_docs([])).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shard(make_docs([(1, None)])).collect()] == [(0, 0)]


def test_written_shards_prune(spark, make_docs, tmp_path):
    rows = [(i, "x" * (i % 50), ("en", "de")[i % 2], f"src{i % 8}") for i in range(400)]
    sharding.write_shards(make_docs(rows), str(tmp_path / "out"), sharding.Settings(shards=8), files_each=1)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 400
    spread = back.groupBy("shard").agg(F.count_distinct("source").alias("n")).collect()
    assert sum(r.n for r in spread) / len(spread) < 5


# --- substring dedup


def slow_dedup(rows, n):
    key = lambda i: -(1 << 63) if i is None else i
    first = {}
    for i, t in rows:
        w = words_of(t)
        for p in range(len(w) - n + 1):
            g = tuple(w[p : p + n])
            first[g] = min(first.get(g, (1 << 63, 0)), (key(i), p))
    out = Counter()
    for i, t in rows:
        w = words_of(t)
        gone = {q for p in range(len(w) - n + 1) if first[tuple(w[p : p + n])] < (key(i), p) for q in range(p, p + n)}
        out[(i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone))] += 1
    return out


@pytest.mark.parametrize("stretch", [6 << 20, 3000])
def test_substring_dedup(spark, make_docs, corpus, stretch):
    rows = [*corpus, (450, " ".join(["again"] * 70)), (451, "x " + " ".join(["again"] * 25)), (452, "q" * 5000)]
    docs = make_docs(rows, ["kept int", "k int"]).repartition(3)
    got = rows_of(substring.dedup(docs, substring.Settings(stretch=stretch)), "doc_id", "n_words", "n_removed", "kept")
    assert got == slow_dedup(rows, 20)
    sha = rows_of(substring.dedup(docs, digest=True), "doc_id", "kept_sha256")
    assert sha == Counter({(i, hashlib.sha256(k.encode()).hexdigest()): n for (i, _, _, k), n in got.items()})


def test_substring_dedup_of_nothing(spark, make_docs):
    assert substring.dedup(make_docs([])).count() == 0
    assert rows_of(substring.dedup(make_docs([(1, None), (2, "a")])), "doc_id", "n_words", "n_removed") == {(1, 0, 0): 1, (2, 1, 0): 1}


def test_words_longer_than_a_piece():
    from quillstream.llm.words import hash_words

    texts = [b"a" * 300 + b" b", b"", None, b"b\tccc\n" + b"d" * 90]
    (whole,), counts = hash_words(texts)
    (small,), again = hash_words(texts, piece=16)
    assert whole.tolist() == small.tolist() and counts.tolist() == again.tolist() == [2, 0, 0, 3]
    assert whole[1] == whole[2]


# --- SimHash


def slow_print(text, n=3):
    w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i : i + n]).encode() for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints, distance=3):
    key = lambda i: -(1 << 63) if i is None else i
    group = {f: {f} for _, f in prints}
    for a in list(group):
        for b in list(group):
            if a < b and (a ^ b).bit_count() <= distance and group[a] is not group[b]:
                group[a] |= group[b]
                for f in group[b]:
                    group[f] = group[a]
    least = {}
    for i, f in prints:
        g = id(group[f])
        least[g] = min(least.get(g, 1 << 63), key(i))
    back = lambda k: None if k == -(1 << 63) else k
    return Counter((i, f"{f:016x}", back(least[id(group[f])])) for i, f in prints)


def test_near_duplicates(spark, make_docs, corpus):
    rows = [*corpus, (700, "a b"), (701, "A  B"), (702, "c")]
    got = rows_of(simhash.near_duplicates(make_docs(rows, ["fp int", "k int"])), "doc_id", "fingerprint", "component_id")
    want = slow_components([(i, slow_print(t)) for i, t in rows])
    assert got == want and len({c for *_, c in want}) < len({i for i, *_ in want})
    kept = simhash.one_of_each(make_docs(rows))
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in want if i == c} and kept.columns[0] == "doc_id"
    assert simhash.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize(("small", "near"), [(6, 8), (2048, 60)])
def test_links_connect_whatever_is_near(spark, small, near):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = {0, *(s for s in seeds)}
    for s in seeds[:3]:
        prints |= {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(near)}
    prints |= {seeds[3] ^ i for i in range(near)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), simhash.Settings(small=small)).collect()
    got = slow_components(list(enumerate(sorted(prints))))
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        parent[max(top(a), top(b))] = min(top(a), top(b))
    assert len({top(p) for p in prints}) == len({c for *_, c in got})


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(40)] + [(5, 5), (-3, 200), (200, -3)] + [(300, 301 + i) for i in range(50)]
    out = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    at = {n: i for i, n in enumerate(nodes)}
    root = packing.roots(len(nodes), np.array([at[a] for a, _ in edges]), np.array([at[b] for _, b in edges]))
    assert {n: out.get(n, n) for n in nodes} == {n: nodes[root[at[n]]] for n in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- media


def test_media(spark, make_docs, corpus):
    rows = [*corpus, (600, "x" * 576), (601, "é" * 5000)]
    docs = make_docs(rows, ["feature int"])
    got = media.media(docs, media.Settings(archive=3000, range=700, batch=500, piece=2)).collect()
    want = Counter()
    for i, t in rows:
        data = (t or "").encode()
        full = data + b"\xff" * (-len(data) % 576 or (0 if data else 576))
        want[(i, len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.payload_sha256, set()).add((r.media_bytes, r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in by.values())
    assert media.media(make_docs([])).count() == 0


def test_members_are_retried_alone(tmp_path, monkeypatch):
    import io
    import zipfile

    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for i in range(5):
            z.writestr(f"{i}/{i}.png", bytes([i]) * 100)
    path = archive_io.write_file(f"file://{tmp_path}", ".zip", held.getvalue())
    calls, plain = Counter(), media.read_member

    def flaky(file, m):
        calls[m.offset] += 1
        if m.name == "2/2.png" and calls[m.offset] < 3 or m.name == "4/4.png":
            raise OSError("lost")
        return plain(file, m)

    monkeypatch.setattr(media, "read_member", flaky)
    reader = media.MediaReader({"path": f"file://{tmp_path}", "rangeBytes": "10000", "retries": "2", "onError": "row"})
    rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    assert [len(r["media"] or b"") for r in rows] == [100, 100, 100, 100, 0] and rows[4]["error"] == "lost"
    assert sorted(calls.values()) == [1, 1, 1, 3, 3] and path.endswith(".zip")
    with pytest.raises(OSError):
        list(media.MediaReader({"path": f"file://{tmp_path}", "retries": "0"}).read(reader.partitions()[0]))


# --- WARC


def slow_pages(rows, least=0):
    first, out = {}, Counter()
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h in rows:
        data, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and f != i and len(data) >= least
        out[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", f if revisit else None)] += 1
    return out


@pytest.mark.parametrize("least", [0, 10])
def test_warc(spark, least):
    rng = random.Random(4)
    trap = "x" + "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5
    rows = [(i, f"http://h/{i}", prose(rng, rng.randrange(1, 400))) for i in range(30)] + [(50 + i, None, "same page for all") for i in range(20)]
    rows += [(90, "http://a\r\nb", None), (91, "", ""), (92, "u", "tiny"), (93, "u", "tiny"), (None, "u", "same page for all"), (None, "u", "alone"), (3, "u", rows[3][2]), (94, "u", trap), (95, "u", "".join(chr(rng.randrange(32, 50000)) for _ in range(30000)))]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, first int")
    s = warc.Settings(least=least, archive=20000, range=900, read_bytes=300, batch=2000)
    assert rows_of(warc.archive(pages, s), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == slow_pages(rows, least)
    assert warc.archive(pages.limit(0), s).count() == 0


def test_warc_manifest_is_one_file(spark):
    """However many tasks write archives, each of which starts processes for a table file of its own."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    rows = [(i, f"http://h/{i}", f"page {i % 40}") for i in range(60)]
    try:
        for k, v in zip(held, ("7", "false", "-1")):
            spark.conf.set(k, v)
        made = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert made.df.count() == 7 and made.df.agg(F.sum("members")).first()[0] == 60
    assert len(made.df.inputFiles()) == 1
    assert rows_of(warc.describe(warc.read(spark, manifest=made.path)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == slow_pages(rows)


def test_false_starts(tmp_path):
    s = warc.Settings()
    inner = gzip.compress(warc.record(1, "u", b"inner", None, False, s), mtime=0)
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    outer = stored.compress(warc.record(2, "u", b"ab" * 50 + inner + b"cd" * 50, None, False, s)) + stored.flush()
    data = outer + gzip.compress(warc.record(3, "u", b"next", None, False, s), mtime=0)
    path = archive_io.write_file(f"file://{tmp_path}", ".warc.gz", data)
    for each in (40, 333, 10**6):
        found = []
        for a in range(0, len(data), each):
            found += [f["warc-record-id"] for _, f, _ in warc.owned(warc._File(path, len(data), 64), a, min(len(data), a + each))]
        assert found == ["<urn:page:2>", "<urn:page:3>"]
