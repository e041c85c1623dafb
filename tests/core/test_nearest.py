"""Search over blocks of rows and of queries, against a plain loop."""

import math
import random

import numpy as np
import pytest

from quillstream.config import Settings
from quillstream.operators import ann, embed, index, nearest
from quillstream.plans.queries import q41_ingest_chunks


def loop(rows, queries, k):
    out = []
    for qid, q in queries:
        scored = []
        for i, v in rows:
            score = None
            if v is not None and q is not None and len(v) == len(q) and None not in v + q:
                dot, a, b = (sum(float(x) * float(y) for x, y in zip(*p)) for p in ((v, q), (v, v), (q, q)))
                score = None if a * b == 0 else dot / (math.sqrt(a) * math.sqrt(b)) if math.isfinite(a * b) else math.nan
            scored.append(((1, 0) if score is None else (0, -math.inf) if math.isnan(score) else (0, -math.floor(score * 1e9 + 0.5)), i))
        out += [(qid, rank + 1, i) for rank, (_, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("most", [3, 10_000])
def test_search_of_odd_vectors_equals_a_loop(spark, monkeypatch, most):
    monkeypatch.setattr(nearest, "LEAST_ROWS", 8)
    monkeypatch.setattr(nearest, "CUT_ROWS", 7)
    random.seed(2)
    kinds = [lambda: [random.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(4)], lambda: [random.gauss(0, 1) for _ in range(4)], lambda: [1.0, 1.0, 1.0, 1.0]]
    rows = [(i, [float(np.float32(x)) for x in kinds[i % 3]()]) for i in range(90)]
    odd = [None, [], [0.0] * 4, [1.0, 2.0], [math.nan, 1.0, 1.0, 1.0], [1.0, None, 1.0, 1.0]]
    rows += [(90 + i, v) for i, v in enumerate(odd)]
    random.shuffle(rows)
    queries = rows[::3] + [r for r in rows[1:] if r[0] >= 90]
    queries = sorted(dict(queries).items())
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = spark.createDataFrame(queries, "query_id long, query array<float>")
    for k in (1, 5, 200):
        assert sorted((r.query_id, r.rank, r.id) for r in index.search(df, asked, k, most=most).collect()) == loop(rows, queries, k)


def test_pairs_are_not_made_as_rows(spark, tmp_path):
    """Neither search sends pairs through a join: a query's candidates are k a block."""
    rows = spark.createDataFrame([(i, [float((i * 7919) % 31), float(i % 13), 1.0]) for i in range(2000)], "vec_id long, embedding array<float>")
    asked = rows.selectExpr("vec_id AS query_id", "embedding AS query").where("query_id % 20 = 0")
    made = ann.fit(rows)
    exact, found = index.search(rows, asked, 5), ann.search(ann.build(rows, made), made, asked, 5, probes=len(made.centroids))
    assert sorted((r.query_id, r.rank, r.id, round(r.score, 9)) for r in exact.collect()) == sorted((r.query_id, r.rank, r.id, round(r.score, 9)) for r in found.collect())
    for df in (exact, found):
        assert "NestedLoopJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_cells_of_any_size_are_laid_out_in_blocks():
    first, parts = ann._layout({0: 3, 1: 4, 2: 95, 3: 2, 5: 9}, 6, 10)
    rows = {}
    for c, n in {0: 3, 1: 4, 2: 95, 3: 2, 5: 9}.items():
        for j in range(parts[c]):
            rows[first[c] + j] = rows.get(first[c] + j, 0) + n / parts[c]
    assert max(rows.values()) <= 10 and parts.tolist() == [1, 1, 10, 1, 1, 1]


def test_one_worker_cuts_and_embeds(spark):
    s = Settings(dimensions=8, embed_input_tokens=3)
    made = embed.embed(spark.createDataFrame([(1, "a b c d e"), (2, "a b c"), (3, None)], "i int, chunk_content string"), None, s)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    got = {r.i: (r.chunk_content, r.content_vector) for r in made.collect()}
    assert got[1] == got[2] and got[1][0] == "a b c" and got[3][0] == "[empty]"


def test_batches_of_python_stages_are_bounded(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    q41_ingest_chunks(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 400
