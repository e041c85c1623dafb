"""Toxicity, secrets, tokenizer and decontamination on small fixtures against slow versions."""

import base64
import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream.llm import bpe, decontaminate, secrets, toxicity
from quillstream.llm.queries import _ranks
from tests.llm.conftest import prose


def sha(data):
    return hashlib.sha256(data).hexdigest()


# --- decontamination


def slow_contamination(text, items, n=8):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = cut(text), set(), set()
    for name, item in items:
        w = cut(item)
        for i in range(max(1, len(w) - n + 1)) if w else ():
            part = w[i : i + n]
            for j in range(len(words) - len(part) + 1):
                if words[j : j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [16 << 20, 400])
def test_contamination(spark, make_docs, corpus, block):
    rng = random.Random(1)
    items = [(i, prose(rng, 25)) for i in range(10)] + [(20, "short item"), (21, ""), (22, None), (23, "Ünïcode TEXT"), (24, items_text := prose(rng, 9)), (24, items_text)]
    rows = [*corpus[:30], *corpus[-6:], (900, f"x {items[0][1]} y {items[1][1]}."), (901, items[2][1].upper().replace(" ", "; ")), (902, "a short item and SHORT, item "), (903, None), (903, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(make_docs(rows, ["n_words int", "items int"]), benchmark, decontaminate.Settings(block_bytes=block)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in out)
    want = []
    for i, t in rows:
        n, h, f = slow_contamination(t, items)
        want.append((str(i), n, h, len(f), f, len(f) >= 2))
    assert got == sorted(want)
    full = [(i, t) for i, t in items if len((t or "").split()) >= 8]
    for least in (1, 2):
        kept = decontaminate.clean(make_docs(rows, ["_items int", "_q0 int"]), benchmark, decontaminate.Settings(block_bytes=block, clean_items=least))
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in rows if len(slow_contamination(t, full)[2]) < least)
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "_items", "_q0"]


def test_one_planted_item_is_enough(spark, make_docs):
    """A passage from one item takes the document away; a short item, or a part of a window, does not."""
    rng = random.Random(2)
    items = [(i, prose(rng, 40, 5000)) for i in range(30)] + [(90, "yes no")]
    inside = [(i, f"{prose(rng, 50, 5000)} {' '.join(t.split()[3 + i % 9 : 11 + i % 20])} {prose(rng, 20, 5000)}") for i, t in items[:30]]
    clean = [(100 + i, f"{prose(rng, 50, 5000)} yes no {' '.join(t.split()[4:11])} end") for i, t in items[:30]]
    kept = decontaminate.clean(make_docs(inside + clean), spark.createDataFrame(items, "item_id long, text string"))
    held = {i for i, t in inside if slow_contamination(t, items[:30])[2]}
    assert len(held) > 20 and {r.doc_id for r in kept.collect()} == {i for i, _ in inside + clean} - held


def test_frequent_shingles_are_no_prefix(spark, make_docs):
    """Windows that share all but one shingle with every document are indexed under that one."""
    rng = random.Random(3)
    line = prose(rng, 30)
    docs = make_docs([(i, f"{prose(rng, 5)} {line}") for i in range(200)])
    w = decontaminate.Windows([("a", (line + " rare").encode())], decontaminate.Settings())
    counts = decontaminate._counts(docs, w.values(), "text")
    index = decontaminate.Index(w, counts)
    known, window, place = index.by[5]
    last = [decontaminate.words_of(w.text[index.begin[i] : index.end[i]])[p : p + 5] for i, p in zip(window, place) if w.text[index.begin[i] : index.end[i]].endswith(b"rare")]
    assert last == [[*(x.encode() for x in line.split()[-4:]), b"rare"]]
    assert sorted(set(counts[5].tolist())) == [0, 200]


def test_contamination_of_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontaminate.contamination(make_docs([(1, "a b")]), none).collect()] == [(1, 2, 0, 0)]
    assert decontaminate.contamination(make_docs([]), none).count() == 0


# --- secrets


def token(header, signature=b"s" * 32):
    part = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    return f"{part(header)}.{part(b'{}')}.{part(signature)}"


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


RSA = der(0x30, der(2, b"\0") + der(2, b"\x01" + b"\x33" * 128) + der(2, b"\x01\0\x01") + 6 * der(2, b"\x12" * 20))
EC = der(0x30, der(2, b"\1") + der(4, b"e" * 32))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, b"k" * 32)))
PUBLIC = [der(0x30, der(0x30, der(6, b"\x2b\x65\x70")) + der(3, b"\0" + b"k" * 32)), der(0x30, der(2, b"\0") + der(2, b"\x01" + b"\x33" * 128)), der(0x30, der(2, b"\x01" + b"\x33" * 128) + der(2, b"\x01\0\x01"))]


def fields(*parts):
    return b"".join(len(x).to_bytes(4, "big") + x for x in parts)


SSH = b"openssh-key-v1\0" + fields(b"none", b"none", b"") + (1).to_bytes(4, "big") + fields(fields(b"ssh-ed25519", b"k" * 32), b"p" * 64)
SSH_PUBLIC = fields(b"ssh-ed25519", b"k" * 32)


def test_structures():
    assert secrets.is_der_key(RSA) and not secrets.is_der_key(RSA[:-1]) and not secrets.is_der_key(RSA + b"x")
    assert secrets.is_ssh_key(SSH) and not secrets.is_ssh_key(SSH[:-1]) and not secrets.is_ssh_key(b"\0" * 40)
    jwt = token(json.dumps({"alg": "HS256"}).encode())
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(re.findall(".{1,64}", base64.b64encode(RSA).decode())) + "\n-----END RSA PRIVATE KEY-----"
    text = f"é {jwt} {base64.b64encode(RSA).decode()} {RSA.hex()} ssh {base64.b64encode(SSH).decode()} {pem}"
    assert secrets.is_der_key(EC) and secrets.is_der_key(PKCS8) and not any(map(secrets.is_der_key, PUBLIC)) and not secrets.is_ssh_key(SSH_PUBLIC)
    kinds = [k for *_, k in secrets.spans(text)]
    assert kinds.count("jwt") == 1 and kinds.count("der") == 2 and kinds.count("ssh") == 1 and kinds.count("pem") == 1
    public = " ".join(["ssh-ed25519 " + base64.b64encode(SSH_PUBLIC).decode(), *(base64.b64encode(x).decode() for x in PUBLIC), *(x.hex().upper() for x in PUBLIC)])
    assert [k for *_, k in secrets.spans(public) if k != "hex"] == []
    none = [token(b'{"alg":"none"}', b""), token(b'{"alg":"none"}'), token(b'{"alg":"HS256"}', b""), token(b'{"alg":"HS256"}', b"short")]
    assert secrets.spans(" ".join(none)) == []
    assert [k for *_, k in secrets.spans(token(b'{"typ": 1}') + " " + token(b"nonsense") + " " + base64.b64encode(bytes(range(90))).decode())] == []


def slow_added(text):
    """The method's spans by trying every run of base64 or hex characters, and every armour, apart from the patterns."""
    out, text = [], text or ""
    for chars, least, decode in (("[A-Za-z0-9+/_-]", 40, secrets.unbase64), ("[0-9A-Fa-f]", 48, None)):
        for m in re.finditer(chars + ("+={0,2}" if decode else "+"), text):
            if len(m[0].rstrip("=")) >= least:
                tries = [(0, len(m[0]))] if decode or len(m[0]) % 2 == 0 else [(0, len(m[0]) - 1), (1, len(m[0]))]
                for a, b in tries:
                    data = decode(m[0]) if decode else bytes.fromhex(m[0][a:b])
                    if data and (secrets.is_der_key(data) or secrets.is_ssh_key(data)):
                        out.append((m.start() + a, m.start() + b, "der" if secrets.is_der_key(data) else "ssh"))
    for m in re.finditer(r"[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*", text):
        if m[0][:2] in ("ey", "ew") and secrets.is_token(m[0]):
            out.append((m.start(), m.end(), "jwt"))
    return out


def test_added_spans(spark, make_docs):
    """The whole spans column: base kinds and what the method adds, in texts that hold both."""
    rng = random.Random(7)
    keys = [base64.b64encode(x).decode() for x in (RSA, EC, PKCS8, SSH)] + [x.hex() for x in (RSA, PKCS8, SSH)] + [x.hex().upper() for x in (EC, RSA)] + ["f" + RSA.hex(), RSA.hex() + "0"]
    keys += [token(b'{"alg":"RS256"}'), token(b'{"alg":"none"}', b""), *(base64.b64encode(x).decode() for x in PUBLIC), "plain", "password = hunter22", "AKIA" + "Q" * 16]
    rows = [(i, " ".join(rng.choices(["é", "word", *keys], k=rng.randrange(1, 8)))) for i in range(200)] + [(900, None), (900, None), (901, "")]
    got = make_docs(rows, ["found int", "spans int"]).select("doc_id", "text", secrets.scan(F.col("text")).alias("got")).collect()
    assert len(got) == len(rows)
    for r in got:
        base = {(a, b, secrets.BASE[k]) for a, k, b in slow_base(r.text)}
        want = sorted(base | set(slow_added(r.text)), key=lambda x: (x[0], secrets.KINDS.index(x[2]), x[1]))
        assert [(x.start, x.end, x.kind) for x in r.got] == want
    assert sum(x.kind not in secrets.BASE for r in got for x in r.got) > 100
    assert make_docs([]).select(secrets.scan(F.col("text"))).count() == 0


def test_armour_with_header_lines():
    body = "\n".join(re.findall(".{1,64}", base64.b64encode(RSA).decode()))
    blocks = base64.b64encode(bytes(range(128))).decode()
    plain = f"-----BEGIN RSA PRIVATE KEY-----\nComment: mine\n\n{body}\n-----END RSA PRIVATE KEY-----"
    shut = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n{blocks}\n-----END RSA PRIVATE KEY-----"
    for key in (plain, shut):
        assert (0, len(key), "pem") in secrets.spans(key)
    assert not any(k == "pem" for *_, k in secrets.spans(shut.replace("4,ENCRYPTED", "4,CLEAR")))


def test_armour_of_other_line_ends_and_hostile_texts():
    body = "\n".join(re.findall(".{1,64}", base64.b64encode(RSA).decode()))
    key = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    for ends in ("\n", "\r\n", "\\n", "\\r\\n", " "):
        other = key.replace("\n", ends)
        assert (3, 3 + len(other), "pem") in secrets.spans(f"é, {other}.")
    begun = "-----BEGIN RSA PRIVATE KEY-----"
    assert (len(begun), len(begun) + len(key), "pem") in secrets.spans(begun + key)
    assert not any(k == "pem" for *_, k in secrets.spans(key.replace("END RSA", "END EC")))
    # a search that goes back would try every way of cutting these into header lines
    for hostile in (begun + "a:" * 5000, begun + "\n" + "A: \n" * 5000, begun + " " * 100_000, begun * 5000, "-----BEGIN " + "A " * 50_000):
        assert secrets.spans(hostile) == []


def slow_base(text):
    text = text or ""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([*(either(w) for w in ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_scan(spark, make_docs, corpus):
    parts = ["password", "PassWd", "api_key", "APIKEY", "token", "ſecret", "=", ": ", '"', "'", " ", "abc", "x" * 6, "AKIA", "A" * 17, "0a" * 12, "f" * 23, "é", "\n", "-_.", "secret"]
    rng = random.Random(3)
    rows = [*corpus, *((1000 + i, "".join(rng.choices(parts, k=rng.randrange(1, 14)))) for i in range(300))]
    docs = make_docs(rows, ["found int"])
    got = docs.select("text", secrets.scan(docs.text).alias("f")).collect()
    for r in got:
        assert [(x.start, secrets.KINDS.index(x.kind), x.end) for x in r.f if x.kind in secrets.BASE] == slow_base(r.text)
    clean = docs.select("text", secrets.redacted(docs.text).alias("r")).collect()
    for r in clean:
        assert (r.r == r.text) == (not secrets.spans(r.text))


# --- tokenizer


@pytest.mark.parametrize("chunk, task", [(40, 400), (300, 1 << 20)])
def test_bpe(spark, make_docs, corpus, chunk, task):
    s = bpe.Settings(_ranks(), chunk=chunk, overlap=chunk // 4, task=task, far=200, far_overlap=50, kept=300)
    rng = random.Random(4)
    odd = ["don't we'll I'M", " " * 500 + "x", "a" * 1500, "?!" * 600, "\n \n  x" * 200, "word " * 50 + " " * 60 + "z", "<|endoftext|> 123456 " * 60, "é世界 " * 300, "x'" * 700, "'s" * 400]
    odd += ["".join(rng.choices(["a", "b ", "  ", "\n", "'s", "1", "2", "!", "'", "é", "世", " ", "don't"], k=900)) for _ in range(25)]
    rows = [*corpus, *((2000 + i, t) for i, t in enumerate(odd)), (2000, odd[0]), (2002, odd[2]), (2002, odd[2])]
    got = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.encode(make_docs(rows, ["ids int", "row int", "copies int"]), s).collect())
    plain = bpe.codec(bpe.Settings(_ranks())).fast
    want = []
    for i, t in rows:
        ids = plain.encode_ordinary(t or "")
        want.append((str(i), len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert got == sorted(want)
    again = bpe.decode(spark.createDataFrame([(1, want[0][2])], "doc_id long, ids binary"), s).first()
    assert bytes(again.decoded) == want[0][3]
    digests = bpe.encode(make_docs(rows[:5]), s, digest=True).collect()
    assert {r.decoded_sha256 for r in digests} == {sha(t.encode()) for _, t in rows[:5]}


def test_bpe_of_nothing(spark, make_docs):
    s = bpe.Settings(_ranks())
    assert bpe.encode(make_docs([]), s).count() == 0
    assert [(r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.encode(make_docs([(1, None), (None, "")]), s).collect()] == 2 * [(0, b"", b"")]


def slow_ids(coder, text):
    return np.array([i for m in coder.cut.finditer(text) for i in coder.fast._encode_single_piece(m[0])], "<u4").tobytes()


def test_chunks_are_stitched():
    """Nearly all tokens of ordinary texts come through stitched chunks, and pieces hold the pattern's own matches."""
    coder = bpe.Codec(bpe.Settings(_ranks(), chunk=256, overlap=32))
    rng = random.Random(2)
    texts = ["".join(rng.choices(["word ", "a", "I'll ", "  ", "\n\n", "12", "!?", "'", "é", "世界", "don't "], k=2000)) for _ in range(20)]
    stitched = total = 0
    for t in texts:
        pieces = list(coder.pieces(t))
        assert [x for p in pieces for x in p] == coder.cut.findall(t)
        stitched += sum(map(len, pieces[1:]))
        total += sum(map(len, pieces))
        assert len(pieces) > len(t) // 256
    assert stitched > 0.9 * total


def test_very_long_pre_tokens():
    coder = bpe.Codec(bpe.Settings(_ranks()))
    for text in ("a" + " " * 9000 + "b" + "\n" * 9000, "x" * 5000 + " y" * 3000 + "?" * 7000 + " z", "'" * 2047 + "ll" * 2000):
        assert coder.encode(text) == slow_ids(coder, text)
    huge = " " * 1_000_000 + "x"
    assert coder.decode(coder.encode(huge)) == huge.encode()


def test_both_engines_cut_alike():
    """The library's engine and the one used here agree about every code point."""
    coder = bpe.Codec(bpe.Settings(_ranks()))
    # planes without characters are sampled
    points = [x for x in range(0x110000) if not 0xD800 <= x < 0xE000 and (x < 0x32000 or x % 97 == 0 or x >> 8 == 0xE00)]
    for at in range(0, len(points), 512):
        text = "".join(f"a{c}a1{c}1!{c}! {c} \n{c}b" for c in map(chr, points[at : at + 512]))
        assert coder.encode(text) == np.array(coder.fast.encode_ordinary(text), "<u4").tobytes()


# --- toxicity


def test_toxicity(spark, make_docs):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(rng, 60).split()
        if toxic:
            for w in rng.sample(["grumbleface", "snotling", "numpty"], 2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    truth = dict(labels)
    rows += [(1000, None), (1001, ""), (None, "snotling"), (0, rows[0][1])]
    labels += [(None, 1), (3, None)]
    docs, known = make_docs(rows, ["score int"]), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.toxicity(docs, known, toxicity.Settings(per_class=200)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert len({r.score for r in out if r.doc_id in (1000, 1001)}) == 1
    assert len({r.score for r in out if r.doc_id == 0}) == 1


def test_toxicity_without_labels(spark, make_docs):
    docs = make_docs([(1, "a"), (2, None)])
    for labels in ([], [(7, 1)], [(1, 1), (2, 1)]):
        out = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len({r.score for r in out}) == 1
    assert toxicity.toxicity(make_docs([]), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_hidden_labels_do_not_leak(spark, make_docs):
    import zlib

    rng = random.Random(8)
    rows = [(i, prose(rng, 20)) for i in range(60)]
    a = [(i, i % 2) for i, _ in rows]
    b = [(i, t if zlib.crc32(str(i).encode()) % 5 else 1 - t) for i, t in a]
    scores = [sorted((r.doc_id, r.score) for r in toxicity.toxicity(make_docs(rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect()) for x in (a, b)]
    assert scores[0] == scores[1]


def test_counts_ratios_and_scores_by_hand(spark, make_docs):
    """On a small vocabulary: n-gram sets, log-count ratios and scores against a slow version with strings."""
    import math

    s = toxicity.Settings(orders=(2, 3), folds=99991, per_class=50, least_df=1, parts=2, entries=500)
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("abc ", k=rng.randrange(5, 30)))) for i in range(60)]
    labels = [(i, int("ab" in t)) for i, t in rows]
    model = toxicity.fit(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), s)
    cut = lambda t: {f" {t} "[i : i + n] for n in (2, 3) for i in range(len(t) + 3 - n)}
    place = lambda g: int(next(toxicity.grams(g, toxicity.Settings(orders=(len(g),))))[1])
    vocabulary = sorted({g for _, t in rows for g in cut(t)})
    code = {g: place(g) for g in vocabulary}
    assert len(set(code.values())) == len(vocabulary)
    assert all(set(toxicity.present(t, s).tolist()) == {code[g] for g in cut(t)} for _, t in rows)
    y = dict(labels)
    n = [sum(v == k for v in y.values()) for k in (0, 1)]
    ratio = {g: math.log((sum(g in cut(t) and y[i] == 1 for i, t in rows) + 1) / (n[1] + 2)) - math.log((sum(g in cut(t) and y[i] == 0 for i, t in rows) + 1) / (n[0] + 2)) for g in vocabulary}
    told = {code[g] for g, r in ratio.items() if r}
    assert set(model.features.tolist()) == told
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    score = model.scorer()
    for _, t in rows + [(0, ""), (0, "zzz" * 9), (0, "ab" * 40)]:
        z = model.bias + sum(weight.get(code[g], 0) for g in cut(t) if g in code)
        unknown = {x for x in toxicity.present(t, s).tolist()} - set(code.values())
        if not unknown & set(weight):
            assert math.isclose(score(t), 1 / (1 + math.exp(-z)), rel_tol=1e-4)
    short = toxicity.Model(toxicity.Settings(orders=(2, 3), piece=7), model.features, model.weights, model.bias).scorer()
    assert all(math.isclose(short(t), score(t), rel_tol=1e-6) for _, t in rows + [(0, "ab ba c" * 900)])


def test_packed_sample_is_the_sample():
    """Texts whose features do not fit unpacked give the same fit."""
    rng = np.random.default_rng(1)
    bits = [np.packbits(rng.random(300) < 0.2) for _ in range(80)]
    y = (np.arange(80) % 3 == 0).astype(float)
    out = [toxicity.solve(toxicity.Sample(bits, 300, t), np.ones(300), y, np.ones(80), np.ones(80, bool), t) for t in (toxicity.Settings(), toxicity.Settings(entries=0, block=7))]
    assert np.allclose(*out, atol=1e-3) and len(toxicity.Sample(bits, 300, toxicity.Settings(entries=0)).held) == 0
