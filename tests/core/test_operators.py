"""Operators that SQL does not cover, and edge cases of those that it does."""

import io
import json
import re
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from quillstream.config import Settings
from quillstream.functions import folds
from quillstream.functions import text as t
from quillstream.operators import ann, chunking, embed, index, metadata, parse, pii, remote
from quillstream.plans import ingest
from quillstream.sources import admission, files
from quillstream.streaming import runner


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


def test_paths(spark):
    rows = [("wiki/Engineering/Platform/setup.pdf", "Engineering > Platform > setup.pdf", "setup.pdf", ".pdf"), ("/Wiki\\SharePoint/a.md", "a.md", "Wiki\\SharePoint/a.md".split("/")[-1], ".md"), ("wiki/documents", "wiki/documents", "documents", ""), ("", "", "", ""), ("a/.hidden", "a > .hidden", ".hidden", ""), ("a/x.tar.GZ", "a > x.tar.GZ", "x.tar.GZ", ".gz"), ("a/..b.c", "a > ..b.c", "..b.c", ".c")]
    df = spark.createDataFrame([(r[0],) for r in rows], "p string")
    got = df.select("p", t.breadcrumb(F.col("p")), t.basename(F.col("p")), t.extension(t.basename(F.col("p")))).collect()
    assert [tuple(r) for r in got] == rows


def test_page_numbers_and_ids(spark):
    df = spark.createDataFrame([("[Page 3]\nx", None), ("x [Page 3]", None), ("[Page 3]", "7"), ("[Page 3]", "0"), ("[Page 99999999999]", None)], "c string, k string")
    assert [r[0] for r in df.select(t.page_number(F.col("c"), F.col("k"))).collect()] == [3, None, 7, 3, None]
    import base64

    path = "é" * 80 + "/ÿ?.md"
    assert one(spark, t.chunk_id(F.lit(path), F.lit(12))) == base64.urlsafe_b64encode(f"{path}_12".encode()).decode().rstrip("=")


def test_decoding(spark):
    df = spark.createDataFrame([(bytearray(b"\xff"),), (bytearray("é".encode()),), (bytearray(b""),)], "b binary")
    assert [tuple(r) for r in df.select(t.decode_text(F.col("b")), t.decode_lossy(F.col("b"))).collect()] == [("ÿ", "�"), ("é", "é"), ("", "")]
    assert one(spark, t.strip(F.lit(" 　\x1cx y \n"))) == "x y"


def test_packing(spark):
    rng = random.Random(1)
    lists = [[8000, 1, 7999, 1], [], [5], [0, 0, 0]] + [[rng.randrange(0, 30) for _ in range(rng.randrange(40))] for _ in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<bigint>")
    for limit, most in ((8000, 16), (25, 3)):
        got = df.select("i", folds.pack(F.col("v"), limit, most, alone=True).alias("r")).collect()
        for r in got:
            v = lists[r.i]
            want = list(embed.spans(v, limit, most))
            assert [(x.start - 1, x.start - 1 + x.n, x.total) for x in r.r] == [(a, b, sum(v[a:b])) for a, b in want]
    plain = df.select("i", folds.pack(F.col("v"), 25).alias("r")).collect()
    for r in plain:
        assert sum(x.n for x in r.r) == len(lists[r.i]) and all(x.total <= 25 or x.n == 1 for x in r.r)


def test_splitter():
    count = chunking.counter()
    rng = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    for size, overlap in ((20, 5), (7, 0), (40, 39)):
        text = "".join(rng.choice([*words, "\n\n", "\n", ". ", " "]) + rng.choice([" ", ""]) for _ in range(600))
        pieces = chunking.split_text(text, size, overlap, chunking.SENTENCES, count)
        assert all(p and p == p.strip() and count(p) <= size for p in pieces)
        at = 0
        for p in pieces:  # pieces follow each other in the text
            found = text.find(p, max(0, at - 600))
            assert found >= 0
            at = found
        joined = "".join("".join(pieces).split())
        assert all(w in joined for w in set(text.split()) if len(w) < 4)
    assert chunking.split_text("a b c", 10, 2, chunking.PLAIN, count) == ["a b c"]
    assert [len(p) for p in chunking.split_text("x" * 10, 1, 0, chunking.PLAIN, len)] == [1] * 10


def test_sheets(spark):
    df = spark.createDataFrame([("junk\nSheet: A\nx\nSheet: B\n",), ("no sheets ",), ("Sheet: A\r\nrow Sheet: no",)], "c string")
    got = [[(s["name"], s.body) for s in r[0]] for r in df.select(chunking.sheets(F.col("c"))).collect()]
    assert got[:2] == [[("A", "x")], [("default", "no sheets")]] and got[2][0][0] == "A"


def test_pages(spark):
    s = one(spark, parse.proportional(F.lit("0123456789"), F.lit(3)))
    assert s == ["012", "345", "6789"]
    assert one(spark, parse.proportional(F.lit("ab"), F.lit(4))) == ["a", "b", "", ""]
    assert one(spark, chunking.page_label(F.lit(3), F.lit(" x "), F.lit("t"))) == "[Page 3]\nx \nt"
    assert one(spark, chunking.page_label(F.lit(3), F.lit(" "))) is None


def test_redaction(spark):
    cases = {
        "mail a.b@c.de now": "mail [EMAIL REDACTED] now", "no one": "no one", "": "", "ssn 123-45-6789, ip 10.0.0.1": "ssn [SSN REDACTED], ip [IP REDACTED]",
        "card 4111 1111 1111 1111 or 4111 1111 1111 1112": "card [CARD REDACTED] or 4111 1111 1111 1112", "😀 x@y.zz 😀": "😀 [EMAIL REDACTED] 😀", "iban DE89 3704 0044 0532 0130 00": "iban [BANK ACCT REDACTED] 00",
    }
    df = spark.createDataFrame([(c, 1) for c in cases] + [(None, 1)], "chunk_content string, pii_entities_x int")
    got = pii.scan(df).collect()
    assert [r.chunk_content for r in got] == [*cases.values(), None] and {r.pii_status for r in got} == {"ok"}
    failed = pii.scan(df.withColumn("file_path", F.lit("a")), entities=F.when(F.col("chunk_content") == "no one", pii.recognise(F.col("chunk_content"))))
    assert {r.pii_status for r in failed.collect()} == {"ok", "failed"} and pii.apply_policy(failed).count() == 0
    assert pii.apply_policy(failed, Settings(pii_policy="proceed")).count() == len(cases) + 1


def test_overlapping_entities_and_reports(spark):
    found = F.array(*(F.struct(F.lit("Email").alias("category"), F.lit(a).alias("offset"), F.lit(n).alias("length"), F.lit(0.8125).alias("score"), F.lit("y" * 25).alias("text")) for a, n in ((0, 5), (3, 4), (7, 2))))
    assert one(spark, pii.splice(F.lit("0123456789"), pii.disjoint(found))) == "[EMAIL REDACTED]56[EMAIL REDACTED]9"
    r = one(spark, pii.report(found))[0]
    assert (r.score, r.end, r.text_preview) == (0.812, 5, "y" * 20 + "...")


def slow_cut(text, most):
    """Pieces by the rule: the rest if it fits, else through the last space after the first character, else as many as fit."""
    if len(text) <= most:
        return [text] if text else []
    space = text[:most].rfind(" ")
    n = space + 1 if space > 0 else most
    return [text[:n], *slow_cut(text[n:], most)]


def test_long_text_cuts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é\n😀" if i % 2 else "ab  ") for _ in range(rng.randrange(0, 400))) for i in range(60)] + ["x" * 170, " " * 120, "x" * 49 + " " + "y" * 60]
    for r in spark.createDataFrame([(x,) for x in texts], "text string").select("text", pii.cut(F.col("text"), 50).alias("p")).collect():
        assert list(r.p) == slow_cut(r.text, 50) and "".join(r.p) == r.text and all(len(p) <= 50 for p in r.p)


class Recogniser:
    """Finds capital words; fails for good on some texts, and for a while on others."""

    def __init__(self):
        self.seen = 0

    def recognise(self, texts):
        assert len(texts) <= 5
        self.seen += 1
        if any("broken" in x for x in texts):
            raise ValueError("no")
        if self.seen % 2:
            raise Busy
        return [[{"category": "Email", "offset": m.start(), "length": m.end() - m.start(), "score": 0.9, "text": m[0]} for m in re.finditer("[A-Z]{3,}", x)] for x in texts]


def test_a_service_that_fails(spark):
    s = Settings(pii_max_chars=60, pii_cut_chars=40)
    long, part = ("word " * 20) + "ABCD " + ("more " * 20), "ABCD " + ("word " * 60) + ("broken " * 20)
    rows = [(1, "an ABC"), (2, "  "), (3, None), (4, long), (5, part), (6, "broken"), (7, "XYZ"), *((10 + i, "DEF and") for i in range(9))]
    df = spark.createDataFrame(rows, "n int, chunk_content string").coalesce(1)
    got = {r.n: r for r in pii.scan(df, s, service=Recogniser(), retry=remote.Retry(base=0)).collect()}
    assert {n: got[n].pii_status for n in (2, 3, 4, 5)} == {2: "ok", 3: "ok", 4: "ok", 5: "partial"}
    assert [n for n in got if got[n].pii_status == "failed"] == [1, 6, 7, 10, 11]  # the five that went together
    for n, text in rows:
        if got[n].pii_status in ("ok", "partial") and text:
            assert got[n].chunk_content == re.sub("[A-Z]{3,}", "[EMAIL REDACTED]", text)
            assert [(e.start, e.end) for e in got[n].pii_entities] == [m.span() for m in re.finditer("[A-Z]{3,}", text)]


def test_a_failing_service_stops_the_stream(spark, tmp_path):
    class Down:
        def recognise(self, texts):
            raise ValueError("down")

    (tmp_path / "in").mkdir()
    store = index.Store(spark, f"file://{tmp_path}/index")
    s = Settings(chunk_tokens=30, overlap_tokens=5, dimensions=16, pii_breaker=2)
    for n in range(3):
        (tmp_path / "in" / f"{n}.txt").write_text(f"text {n}")
        q = runner.ingest_files(spark, f"file://{tmp_path}/in", store, f"{tmp_path}/check{n}", f"{tmp_path}/dead{n}", s, described, service=Down())
        q.awaitTermination()
        assert spark.read.json(f"{tmp_path}/dead{n}").where("error like 'pii_scan%'").count() == n + 1 and store.read().isEmpty()
    b = runner.PiiBreaker(2)
    b.see(0, 3)
    with pytest.raises(RuntimeError):
        b.see(0, 1)


@pytest.mark.parametrize("mode", ["event", "queue"])
def test_notified_files(spark, tmp_path, mode):
    root, box = tmp_path / "in", tmp_path / "box"
    (root / "wiki").mkdir(parents=True)
    box.mkdir()
    for name, body in {"wiki/a.Md": MD, "b.TXT": "mail x@y.zz", "big.txt": "z" * 3000, "never.txt": "not named"}.items():
        (root / name).write_text(body)
    one = lambda p: json.dumps({"url": f"https://s/raw-documents/{p}", "contentLength": 9})
    lines = [one("wiki/a.Md"), '{"data": ' + one("b.TXT") + "}", one("big.txt"), one("gone.txt"), one("x.exe"), "no json"]
    (box / "m.txt").write_text("\n".join(lines if mode == "event" else [f"[{lines[0]}, {lines[1]}]", *lines[2:]]))
    store = index.Store(spark, f"file://{tmp_path}/index")
    s = Settings(chunk_tokens=30, overlap_tokens=5, dimensions=16, max_file_bytes=2000)
    q = runner.ingest_notified(spark, mode, str(box), f"file://{root}", store, f"{tmp_path}/check", f"{tmp_path}/dead", s, described)
    q.awaitTermination()
    assert q.exception() is None
    assert {r.file_path for r in store.read().select("file_path").distinct().collect()} == {"wiki/a.Md", "b.TXT"}
    errors = {r.blob_path: r.error for r in spark.read.option("recursiveFileLookup", "true").json(f"{tmp_path}/dead").collect()}
    assert set(errors) == {"big.txt", "gone.txt", "no json"} and "exceeds" in errors["big.txt"] and errors["gone.txt"].startswith("read: ")
    with pytest.raises(ValueError):
        runner.ingest_notified(spark, "both", str(box), f"file://{root}", store, "c", "d")


def test_extensions_in_any_case_and_sizes(spark, tmp_path):
    for name in ("a.Pdf", "b.TXT", "c.md", "d.Txt", "e.eXe"):
        (tmp_path / name).write_text("x" * (10 if name != "d.Txt" else 99))
    root = f"file://{tmp_path}"
    assert sorted(r.file_path.lstrip("/") for r in files.read_files(spark, root, Settings(max_file_bytes=50)).select("file_path").collect()) == ["a.Pdf", "b.TXT", "c.md"]
    assert [(r.file_path.lstrip("/"), r.length) for r in files.oversize(spark, root, Settings(max_file_bytes=50)).collect()] == [("d.Txt", 99)]


def test_field_roles():
    roles = {f.name: set(f.metadata["roles"]) for f in index.SCHEMA}
    has = lambda role: {n for n, r in roles.items() if role in r}
    assert has("filter") == set(roles) - {"chunk_content", "content_vector", "file_path"}
    assert has("sort") == {"document_title", "chunk_index", "page_number", "last_modified", "ingested_at"}
    assert has("facet") == {"source_type", "file_name", "pii_redacted"} and has("key") == {"id"}
    assert has("semantic_keywords") == {"source_type", "file_name", "breadcrumb"} and has("semantic_title") == {"document_title"} and has("semantic_content") == {"chunk_content"}


def test_text_queries_find_their_chunks(spark):
    s = Settings(dimensions=64)
    chunks = spark.createDataFrame([(i, f"topic{i} word{i} common") for i in range(20)], "vec_id long, chunk_content string")
    made = embed.embed(chunks, embed.HashModel(64), s)
    queries = index.text_queries(spark.createDataFrame([(i, f"topic{i} word{i}") for i in (3, 7)], "query_id long, query_text string"), embed.HashModel(64), s)
    assert {(r.query_id, r.id) for r in index.search(made, queries, 1, vector_col="content_vector").collect()} == {(3, 3), (7, 7)}


def test_a_remote_model_under_a_quota():
    waits, asked = [], []

    def client(texts):
        asked.append(len(texts))
        if len(asked) == 1:
            raise Busy
        if len(asked) == 2:
            return [(0, [1.0])], {}  # too few: asked again
        return [(i, [float(i)]) for i in range(len(texts))], {"x-ratelimit-remaining-tokens": "10", "x-ratelimit-limit-tokens": "6000"}

    model = embed.Service(client, callers=10, sleep=waits.append, size=lambda _: 20)
    assert model.embed(["a", "b"]) == [(0, [0.0]), (1, [1.0])] and len(asked) == 3
    before = len(waits)
    model.embed(["a", "b"])
    assert waits[before] == pytest.approx(0.5) and waits[-1] == pytest.approx(40 / (6000 / 10) * 60, abs=0.1)


def test_many_matches_in_one_text(spark):
    """A text full of matches takes no time that grows with their square in interpreted steps."""
    import time

    text = "mail a@b.cc and " * 4000
    began = time.time()
    r = spark.createDataFrame([(text,)], "text string").select(pii.splice(F.col("text"), pii.disjoint(pii.recognise(F.col("text"), pii.RULES[:1]))).alias("t")).first()
    assert r.t == text.replace("a@b.cc", "[EMAIL REDACTED]") and time.time() - began < 30


MD = """---
title: x
---
intro *text*

# One
para line
next

## Two
| a | b |
|---|---|
| 1 | 2 |

- x
  - y
- z

```
code # no heading
```
# Three
> said

Under
-----
end [link](http://x)
"""


def test_markdown():
    p = parse.markdown(MD)
    assert [(h["level"], h["context_path"]) for h in p["headers"]] == [(1, "One"), (2, "One > Two"), (1, "Three"), (2, "Three > Under")]
    assert p["tables"] == [{"headers": ["a", "b"], "rows": [["1", "2"]]}] and p["front_matter"].strip() == "title: x"
    assert p["sections"] == ["intro text", "Section: One\n\npara line\nnext", "Section: One > Two\n\na | b\n1 | 2\n\n- x\n  - y\n- z\n\ncode # no heading", "Section: Three\n\nsaid", "Section: Three > Under\n\nend link"]
    assert parse.markdown("")["sections"] == []


def packed(parts):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return held.getvalue()


REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
DOCX = packed({"word/document.xml": '<w:document xmlns:w="w"><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a </w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'})
XLSX = packed({
    "xl/workbook.xml": f'<workbook xmlns="m" {REL}><sheets><sheet name="S1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="p"><Relationship Id="r1" Type="x/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    "xl/sharedStrings.xml": '<sst xmlns="m"><si><t>name</t></si></sst>',
    "xl/worksheets/sheet1.xml": '<worksheet xmlns="m"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2.5</v></c></row><row><c r="A2"><v> </v></c></row><row><c r="B3" t="b"><v>1</v></c></row></sheetData></worksheet>',
})
PPTX = packed({
    "ppt/presentation.xml": f'<p:presentation xmlns:p="p" {REL}><p:sldIdLst><p:sldId id="256" r:id="r1"/></p:sldIdLst></p:presentation>',
    "ppt/_rels/presentation.xml.rels": '<Relationships xmlns="q"><Relationship Id="r1" Type="x/slide" Target="slides/slide1.xml"/></Relationships>',
    "ppt/slides/slide1.xml": '<p:sld xmlns:p="p" xmlns:a="a"><p:sp><p:txBody><a:p><a:r><a:t>Title</a:t></a:r></a:p></p:txBody></p:sp></p:sld>',
    "ppt/slides/_rels/slide1.xml.rels": '<Relationships xmlns="q"><Relationship Id="n" Type="x/notesSlide" Target="../notesSlides/n1.xml"/></Relationships>',
    "ppt/notesSlides/n1.xml": '<p:notes xmlns:p="p" xmlns:a="a"><p:sp><p:nvPr><p:ph type="body"/></p:nvPr><p:txBody><a:p><a:r><a:t>say this</a:t></a:r></a:p></p:txBody></p:sp></p:notes>',
})


def test_office():
    assert parse.parse_bytes("docx", DOCX)["full_text"] == "Hello\n\na | b"
    assert parse.parse_bytes("xlsx", XLSX)["full_text"] == "Sheet: S1\nname |  | 2.5\n | True"
    p = parse.parse_bytes("pptx", PPTX)
    assert p["full_text"] == "Slide 1:\nTitle\n[Speaker Notes] say this" and p["pages"][0]["page"] == 1
    assert parse.parse_bytes("docx", b"junk")["error"].startswith("BadZipFile") and parse.parse_bytes("pdf", b"x")["error"]


def test_admission(spark):
    msgs = ['{"url": "u", "contentLength": 3}', '{"data": {"url": "v"}}', '[{"url": "a"}, {"data": {"url": "b"}}]', "nonsense", "[]", "null"]
    got = admission.unwrap(spark.createDataFrame([(m,) for m in msgs], "value string")).select("url").collect()
    assert [r.url for r in got if r.url] == ["u", "v", "a", "b"]
    assert one(spark, admission.strip_container(F.lit("raw-documents/a/b"), "raw-documents")) == "a/b"


def test_metadata(spark):
    merged = one(spark, metadata.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("a"), F.lit(""), F.lit("b"), F.lit("3"))))
    assert merged == {"a": "1", "b": "3"}


class Busy(Exception):
    status_code = 503


def test_retries():
    waits, calls = [], []

    def step():
        calls.append(1)
        if len(calls) < 3:
            raise Busy
        return 7

    assert remote.call(step, sleep=waits.append) == 7 and len(waits) == 2 and all(0 <= w <= 2**i for i, w in enumerate(waits))
    with pytest.raises(ValueError):
        remote.call(lambda: (_ for _ in ()).throw(ValueError("bad")), sleep=waits.append)
    q = remote.Quota(callers=30)
    q.read({"x-ratelimit-remaining-tokens": "3000", "x-ratelimit-remaining-requests": "1", "x-ratelimit-limit-tokens": "junk"})
    assert q.throttle(10) == 2.0 and 2.5 <= q.throttle(8000) <= 62 and q.pace(8000) == 60


def test_failed_batches_leave_null_vectors(spark):
    class Half:
        def embed(self, texts):
            if any("bad" in x for x in texts):
                raise Busy
            return [(i, [1.0]) for i in reversed(range(len(texts)))]

    df = spark.createDataFrame([("good",), ("bad",)], "chunk_content string").coalesce(1)
    got = embed.embed(df, Half(), Settings(embed_batch=1)).collect()
    assert [r.content_vector for r in got] == [[1.0], None]
    long = embed.embed(spark.createDataFrame([("a b c d",), ("",), (None,)], "chunk_content string"), s=Settings(embed_input_tokens=3, dimensions=8)).collect()
    assert [r.chunk_content for r in long] == ["a b c", "[empty]", "[empty]"] and all(len(r.content_vector) == 8 for r in long)


SMALL = Settings(chunk_tokens=30, overlap_tokens=5, dimensions=16)


def write_tree(root):
    for name, body in {"wiki/a.md": MD.encode(), "b.txt": b"mail x@y.zz " * 30, "wiki/c.docx": DOCX, "d.docx": b"junk", "e.exe": b"x", "f.txt": b"", "g.txt": b"  \n", "h.xlsx": XLSX, "x.txt.error.json": b"{}"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(body)


def described(df):
    return df.withColumn("source_type", F.lit("wiki")).withColumn("source_url", F.concat(F.lit("https://w/"), "file_path"))


def test_files_to_index_in_batch_and_as_a_stream(spark, tmp_path):
    write_tree(tmp_path / "in")
    found = files.read_files(spark, f"file://{tmp_path}/in")
    assert sorted(r.file_path.lstrip("/") for r in found.select("file_path").collect()) == ["b.txt", "d.docx", "g.txt", "h.xlsx", "wiki/a.md", "wiki/c.docx"]
    docs = ingest.documents(described(found))
    made = ingest.chunks(docs, SMALL)
    rows = {r.file_path.lstrip("/"): r for r in ingest.status(docs, made).collect()}
    assert {k: (r.status, r.stage) for k, r in rows.items()} == {"wiki/a.md": ("success", None), "b.txt": ("success", None), "wiki/c.docx": ("success", None), "d.docx": ("error", "parse"), "g.txt": ("skipped", None), "h.xlsx": ("success", None)}
    assert rows["b.txt"].pii_chunks_redacted == rows["b.txt"].chunks_created > 1
    batch = made.select("id", "chunk_content", "chunk_index", "total_chunks").collect()
    assert len({r.id for r in batch}) == len(batch) and any(r.chunk_content.startswith("[Sheet: S1]\n") for r in batch)
    store = index.Store(spark, f"file://{tmp_path}/index")
    for _ in range(2):  # the second run finds nothing new
        q = runner.ingest_files(spark, f"file://{tmp_path}/in", store, f"{tmp_path}/check", f"{tmp_path}/dead", SMALL, described)
        q.awaitTermination()
        assert q.exception() is None
        assert sorted(map(tuple, store.read().select("id", "chunk_content", "chunk_index", "total_chunks").collect())) == sorted(map(tuple, batch))
    assert spark.read.json(f"{tmp_path}/dead").count() == 1
    state = store.state()
    store.write(store.read(), state["batch"])  # a replay
    assert store.state() == state


def test_a_document_without_vectors_keeps_its_old_chunks(spark):
    old = spark.createDataFrame([("1", "a", [1.0]), ("2", "b", [1.0])], "id string, file_path string, content_vector array<float>")
    new = spark.createDataFrame([("9", "a", None), ("8", "b", [2.0])], "id string, file_path string, content_vector array<float>")
    assert sorted(r.id for r in index.replace(old, new).collect()) == ["1", "8"]


def test_search_over_blocks_of_queries(spark):
    rng = random.Random(4)
    rows = spark.createDataFrame([(i, [rng.random() for _ in range(4)]) for i in range(60)], "vec_id long, embedding array<float>")
    queries = rows.where("vec_id < 7").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    whole, blocks = (sorted((r.query_id, r.rank, r.id) for r in index.search(rows, queries, 3, most=m).collect()) for m in (100, 2))
    assert whole == blocks and len(whole) == 21 and all(q == i for q, r, i in whole if r == 1)


def stored(spark, rows):
    """Chunks as the index holds them, from (id, file_path, vector or None)."""
    made = spark.createDataFrame(rows, "id string, file_path string, content_vector array<float>")
    return made.select(*(F.col(f.name) if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in index.SCHEMA))


def test_runs_of_the_index_equal_replacing_in_one_table(spark, tmp_path):
    rng, store = random.Random(8), index.Store(spark, f"file://{tmp_path}/index")
    want, earlier = {}, None
    for batch in range(12):
        docs = {f"d{rng.randrange(40)}": rng.randrange(1, 4) for _ in range(1 if batch % 3 else 12)}
        blank = {p for p in docs if rng.random() < 0.3}  # their chunks have no vector, so the old ones stay
        rows = [(f"{p}-{batch}-{i}", p, None if p in blank else [float(i)]) for p, n in docs.items() for i in range(n)]
        store.put(stored(spark, rows), batch)
        want |= {p: {f"{p}-{batch}-{i}" for i in range(n)} for p, n in docs.items() if p not in blank}
        now = sorted(r.id for r in store.read().select("id").collect())
        assert now == sorted(i for ids in want.values() for i in ids)
        if earlier is not None:  # a frame taken before the last write can still be read
            assert sorted(r.id for r in earlier[0].select("id").collect()) == earlier[1]
        earlier = (store.read(), now)
        sizes = [store._bytes(r) for r in store.state()["runs"]]
        assert all(size >= sum(sizes[i + 1 :]) for i, size in enumerate(sizes[:-1]))
    state = store.state()
    store.put(stored(spark, [("x", "d1", [1.0])]), state["batch"])  # a replay
    assert store.state() == state
    named = {r for p in store._names("done-") for r in store._pointer(p)["runs"]}
    assert len(store._names("done-")) == store.keep and set(store._names("run-")) == named
    store.write(stored(spark, [("y", "d1", [1.0])]), state["batch"] + 1)
    assert [r.id for r in store.read().collect()] == ["y"]


def test_approximate_search_recalls_the_exact_neighbours(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    made = ann.fit(rows)
    built = ann.build(rows, made)
    assert built.where("cell < 0").isEmpty() and built.select("cell").distinct().count() > 20
    exact = index.search(rows, queries, 5)
    assert ann.recall(ann.search(built, made, queries, 5), exact) >= 0.9
    assert ann.recall(ann.search(built, made, queries, 5, probes=len(made.centroids)), exact) == 1.0


def test_approximate_search_of_rows_without_vectors(spark):
    shape = "vec_id long, embedding array<float>"
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0]), (5, [0.9, 0.1]), (5, [0.9, 0.1]), (6, [float("nan"), 1.0])], shape)
    made = ann.fit(rows)
    built = ann.build(rows, made)
    assert {r.vec_id for r in built.where("cell < 0").collect()} == {2, 3, 4, 6}
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (8, None), (9, [0.0, 0.0])], "query_id long, query array<float>")
    assert [(r.query_id, r.rank, r.id) for r in ann.search(built, made, queries, 2).orderBy("rank").collect()] == [(7, 1, 1), (7, 2, 5)]
    none = rows.where("false")
    assert ann.search(ann.build(none, ann.fit(none)), ann.fit(none), queries, 2).isEmpty()
