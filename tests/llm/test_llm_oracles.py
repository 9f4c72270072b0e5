"""Queries that SQL can express equal it on a driver folder."""

import duckdb
import pytest

from clearshelf.llm.oracles import ORACLES
from clearshelf.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    assert df.columns == [c[0] for c in result.description]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(result.fetchall(), key=str)
