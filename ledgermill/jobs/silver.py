"""Bronze tables to silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.jobs import bronze as bronze_job
from ledgermill.plans import silver, tables
from ledgermill.sources.layers import read_table, register, write_table

NAMES = {name: f"silver_{name.removesuffix('_data')}" for name in schemas.SILVER}


def run(spark: SparkSession, bronze_dir: str, silver_dir: str) -> dict[str, dict[str, object]]:
    """Writes the three tables; returns rows written and customers only billing knows."""
    cleaned = tables.silver_tables(bronze_job.read(spark, bronze_dir))
    return {
        NAMES[schemas.CRM]: write_table(
            cleaned[schemas.CRM],
            silver_dir,
            NAMES[schemas.CRM],
            billing_only=F.count_if("billing_only_flag"),
        ),
        NAMES[schemas.BILLING]: write_table(
            silver.with_month(cleaned[schemas.BILLING]),
            silver_dir,
            NAMES[schemas.BILLING],
            partition_by="month",
        ),
        NAMES[schemas.CHURN]: write_table(cleaned[schemas.CHURN], silver_dir, NAMES[schemas.CHURN]),
    }


def read(spark: SparkSession, silver_dir: str) -> dict[str, DataFrame]:
    """The silver tables by table name; also registered for SQL."""
    stored = {
        name: read_table(spark, silver_dir, NAMES[name], schema)
        for name, schema in schemas.SILVER.items()
    }
    register({NAMES[name]: table for name, table in stored.items()})
    return stored
