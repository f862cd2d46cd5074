"""Every query of the library against the same question in SQL on another engine."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks import oracle, registry

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return float(f"{v:.9g}") if isinstance(v, float) and math.isfinite(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN"}
    assert {c: kinds[t] for c, t in df.dtypes} == {
        c: str(t) for c, t in zip(result.columns, result.types)
    }
    ours = _normal([tuple(row) for row in df.collect()], df.columns)
    theirs = _normal(result.fetchall(), result.columns)
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() == 1
