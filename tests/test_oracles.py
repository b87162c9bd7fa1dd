"""Every registered query against its SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from workload.queries import REGISTRY

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{SF_DIR}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def bag(columns, rows):
    """Rows without order, with columns in the order of their names."""
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(row[n] for n in order) for row in rows)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    ours = queries()[name](spark, SF_DIR)
    theirs = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    assert bag(ours.columns, ours.collect()) == bag(columns, theirs.fetchall())
