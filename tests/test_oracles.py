"""Every query with a SQL oracle equals it row by row; the others are checked by their rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from clearshelf.plans.oracles import ROWS_ONLY, oracles
from clearshelf.plans.queries import registered

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}
QUERIES = registered()
ORACLES = oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _ordered(rows):
    def clean(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    def key(row):
        return tuple((v is None, 0 if v is None else v) for v in row)

    return sorted((tuple(clean(v) for v in row) for row in rows), key=key)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    types = [str(c[1]) for c in result.description]
    expected = result.fetchall()
    assert df.columns == names
    assert [TYPES[t] for _, t in df.dtypes] == types
    assert _ordered(df.collect()) == _ordered(expected)
    assert expected, "the fixture must not leave the query empty"


def test_only_model_queries_have_no_oracle():
    assert set(QUERIES) - set(ORACLES) == set(ROWS_ONLY)


def test_all_of_them_are_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_model_beats_the_mean(spark, sf_dir):
    rows = {r.split: r for r in QUERIES["train_model"](spark, sf_dir).collect()}
    assert rows["train"].model_mae < rows["train"].mean_mae


def test_tuning_ranks_trials(spark, sf_dir):
    errors = [r.val_mae for r in QUERIES["tune_model"](spark, sf_dir).collect()]
    assert len(errors) == 4
    assert errors == sorted(errors)


def test_importances_sum_to_one(spark, sf_dir):
    rows = QUERIES["feature_importance"](spark, sf_dir).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0, abs=1e-4)
