"""The native operators' queries against their DuckDB SQL over the small tables."""

import os
from collections import Counter

import duckdb
import pytest

from quillstream.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    found = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(found.fetchall())
