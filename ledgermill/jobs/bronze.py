"""CSV extracts to bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.plans import quality, tables
from ledgermill.sources.extracts import read_extracts
from ledgermill.sources.layers import read_table, register, write_table

NAMES = {name: f"bronze_{name.removesuffix('_data')}" for name in schemas.EXTRACTS}


def run(spark: SparkSession, extracts_dir: str, bronze_dir: str) -> dict[str, dict[str, object]]:
    """Writes the three tables; returns rows written and dates that did not parse. Each extract is
    read once."""
    typed = tables.bronze_tables(read_extracts(spark, extracts_dir))
    unparsed = F.count_if(F.col("signup_date").isNull())
    measures = {schemas.CRM: {"null_signup_dates": unparsed}}
    return {
        NAMES[name]: write_table(table, bronze_dir, NAMES[name], **measures.get(name, {}))
        for name, table in typed.items()
    }


def read(spark: SparkSession, bronze_dir: str) -> dict[str, DataFrame]:
    """The bronze tables by table name; also registered for SQL."""
    stored = {
        name: read_table(spark, bronze_dir, NAMES[name], schema)
        for name, schema in schemas.BRONZE.items()
    }
    register({NAMES[name]: table for name, table in stored.items()})
    return stored


def validate(spark: SparkSession, bronze_dir: str) -> dict[str, dict[str, object]]:
    """Totals of the written tables, one row each."""
    stored = read(spark, bronze_dir)
    return {
        NAMES[schemas.CRM]: quality.crm_validation(stored[schemas.CRM]).first().asDict(),
        NAMES[schemas.BILLING]: quality.billing_validation(stored[schemas.BILLING])
        .first()
        .asDict(),
    }
