import random

import pytest


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=()):
        shape = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {e}" for e in extra)
        full = [(*r[:2], *(r[2:] or ("en", "src0")), None if r[1] is None else len(r[1]), *([7] * len(extra))) for r in rows]
        return spark.createDataFrame(full, shape)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Nulls, empty and long texts, exact and near copies, shared passages, repeated ids and rows."""
    rng = random.Random(5)
    passage, base = prose(rng, 60), prose(rng, 300)
    rows = [(i, prose(rng, rng.randrange(1, 80))) for i in range(40)]
    rows += [(100 + i, f"{prose(rng, 30)} {passage} {prose(rng, rng.randrange(0, 30))}") for i in range(12)]
    rows += [(200 + i, base) for i in range(10)]
    rows += [(300 + i, " ".join([*base.split()[: 290 - i], f"new{i}"])) for i in range(10)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (None, passage), (None, None), (403, "one"), (404, f"{passage} {passage}\n{passage}")]
    rows += [(405, prose(rng, 4000, 20)), (406, prose(rng, 3000)), (5, prose(rng, 30)), (100, rows[40][1]), (7, "dup " + passage), (7, passage + " dup")]
    rows += [(500, "é" * 50 + " Ünïcode text   ſecret Kelvin K"), (501, "UPPER Case É ÀB")]
    return rows
