"""Every operator and stage: empty tables, columns with clashing names, repeated rows, nulls in every column."""

from collections import Counter

import pytest

import corpus_pipeline
from quillstream.llm import bpe, chat, common, decontaminate, media, secrets, sharding, simhash, substring, toxicity, warc
from quillstream.llm.queries import _ranks
from tests.llm.conftest import prose

CLASHING = ["k string", "h string", "c string", "_k string", "_h string", "_row string", "_items string", "_id string", "_doc string", "_q0 string", "tag string", "mark string", "fp string", "node string", "root string", "page string", "n string", "copies string", "spans string", "key string", "start string", "b long"]


def benchmark(spark, rows=((1, "one two three four five six seven eight nine"),)):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark, rows=((1, 0), (2, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, toxic int")


OPERATORS = {
    "sharding": lambda spark, d: sharding.shard(d),
    "substring": lambda spark, d: substring.dedup(d),
    "simhash": lambda spark, d: simhash.near_duplicates(d),
    "one_of_each": lambda spark, d: simhash.one_of_each(d),
    "contamination": lambda spark, d: decontaminate.contamination(d, benchmark(spark)),
    "clean": lambda spark, d: decontaminate.clean(d, benchmark(spark)),
    "bpe": lambda spark, d: bpe.encode(d, bpe.Settings(_ranks())),
    "toxicity": lambda spark, d: toxicity.toxicity(d, labels(spark)),
    "secrets": lambda spark, d: d.select("doc_id", secrets.scan(d.text)),
    "media": lambda spark, d: media.media(d),
}


def clashing(spark, rows):
    shape = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(CLASHING)
    return spark.createDataFrame([(i, t, "en", "s", 1, *("x" if "string" in c else 1 for c in CLASHING)) for i, t in rows], shape)


ROWS = [(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, None), (None, "a b c"), (None, None), (4, ""), (5, "one two three four five six seven eight nine")]


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, name):
    assert OPERATORS[name](spark, clashing(spark, [])).count() == 0
    out = OPERATORS[name](spark, clashing(spark, ROWS))
    got = Counter(r.doc_id for r in out.collect())
    want = Counter(i for i, _ in ROWS)
    if name == "one_of_each":
        assert got == Counter({None: 2, 5: 1})  # equal texts are copies, and so are empty ones; a null id is the smallest
    elif name == "clean":
        assert got == want - Counter([5])
    else:
        assert got == want
    if name in ("clean", "one_of_each"):
        assert out.columns == clashing(spark, []).columns


def test_nulls_in_every_column(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(None,) * 5] * 3, shape)
    for name, run in OPERATORS.items():
        assert run(spark, docs).count() == (1 if name == "one_of_each" else 3), name
    turns = spark.createDataFrame([(None,) * 4] * 3, "conv_id long, turn long, role string, text string")
    assert [(r.n_turns, r.n_copies) for r in chat.format_chats(turns).collect()] == [(3, 1)]
    pages = spark.createDataFrame([(None,) * 3] * 3, "page_id long, url string, html string")
    assert [tuple(r) for r in warc.archive(pages).select("payload_bytes", "record_type", "refers_to").collect()] == 3 * [(0, "response", None)]
    none = benchmark(spark, [(None, None)])
    assert decontaminate.contamination(docs, none).where("n_hit = 0").count() == 3
    assert toxicity.toxicity(docs, labels(spark, [(None, None)])).count() == 3


def test_empty_chats_and_pages(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string, k long")).count() == 0
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string, sha string, first long")).count() == 0
    pages = spark.createDataFrame([(1, "u", "x", "s", 2), (1, "u", "x", "s", 2), (2, "u", "x", "s", 2)], "page_id long, url string, html string, sha string, first long")
    assert Counter((r.page_id, r.record_type) for r in warc.archive(pages).collect()) == Counter({(1, "response"): 2, (2, "revisit"): 1})


@pytest.mark.parametrize("rows", [[], ROWS], ids=["empty", "few"])
def test_pipeline_stages(spark, tmp_path, rows):
    """Each stage on an empty table and on one with clashing names; all but the last keep the columns."""
    folder = str(tmp_path)
    clashing(spark, rows).write.parquet(f"{folder}/documents.parquet")
    benchmark(spark).write.parquet(f"{folder}/benchmark.parquet")
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert name == "bpe" or out.columns == docs.columns
        assert (out.count() > 0) == bool(rows)
    assert corpus_pipeline.run(spark, folder).count() <= len(rows)


def test_ids_must_be_integers(spark):
    docs = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    for run in (substring.dedup, simhash.near_duplicates, sharding.shard, media.media):
        with pytest.raises(TypeError, match="integers"):
            run(docs.selectExpr("*", "'e' lang", "'s' source"))


def test_tables_go(spark, tmp_path):
    table = common.Table(spark.range(3), "mine")
    assert table.df.count() == 3
    table.drop()
    with pytest.raises(Exception):
        table.df.count()


def test_very_long_texts(spark, make_docs):
    """Texts of over a million characters beside short ones, in the operators that look at every word."""
    import random

    long = prose(random.Random(1), 250_000, 90_000)
    docs = make_docs([(1, long), (2, long), (3, "short"), (4, "x" * 1_500_000)])
    assert {(r.doc_id, r.n_removed) for r in substring.dedup(docs).collect()} == {(1, 0), (2, 250_000), (3, 0), (4, 0)}
    assert len({r.fingerprint for r in simhash.near_duplicates(docs).where("doc_id < 3").collect()}) == 1
    assert decontaminate.contamination(docs, benchmark(spark, [(9, " ".join(long.split()[100_000:100_020]))])).where("n_items = 1 and n_hit >= 20").count() == 2
    assert {r.predicted for r in toxicity.toxicity(docs, labels(spark)).collect()} <= {0, 1}
