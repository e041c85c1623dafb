"""Each query with oracle SQL against DuckDB over the same tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from quillstream.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF)
    got_columns, got = counted(df.columns, df.collect())
    found = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    want_columns, want = counted(columns, found.fetchall())
    assert got_columns == want_columns
    assert len(got) == len(want) and got == want, (list((got - want).items())[:2], list((want - got).items())[:2])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
