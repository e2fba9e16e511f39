"""Corpus queries against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from casebook.llm import queries
from casebook.llm.oracle import SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in data), key=repr)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_its_sql(spark, con, key):
    df = queries.QUERIES[key](spark, SF)
    got = canon(df.columns, map(tuple, df.collect()))
    cursor = con.execute(SQL[key])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canon(columns, cursor.fetchall())
