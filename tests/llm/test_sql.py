"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from ledgermill.llm import oracle, queries

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: float(f"{v:.9g}") if isinstance(v, float) and math.isfinite(v) else v
    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(sf_dir, 'documents.parquet')}'")
    df, result = queries.queries()[name](spark, sf_dir), duck.sql(oracle.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert {c: KINDS[t] for c, t in df.dtypes} == {c: str(t) for c, t in zip(result.columns, result.types, strict=True)}
    assert _normal([tuple(r) for r in df.collect()], df.columns) == _normal(result.fetchall(), result.columns)
