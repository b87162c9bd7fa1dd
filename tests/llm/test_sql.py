"""The queries that have SQL, against it, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from ledgertag.llm.queries import LLM_ORACLES, LLM_QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    theirs = duck.execute(LLM_ORACLES[name])
    columns = sorted(c[0] for c in theirs.description)
    order = sorted(range(len(columns)), key=lambda k: theirs.description[k][0])
    want = Counter(tuple(r[k] for k in order) for r in theirs.fetchall())
    ours = LLM_QUERIES[name](spark, DATA)
    assert sorted(ours.columns) == columns
    assert Counter(map(tuple, ours.select(*columns).collect())) == want
