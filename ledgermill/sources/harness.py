"""The three extracts, derived from the order tables this repository is checked on.

Billing rows are order lines, so transaction ids repeat naturally, with copies that differ, and one
customer is billed on several plans. A tenth of the customers is left out of the CRM.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.session import raise_partitions
from ledgermill.sources.lazy import LazyTables

# Fixed values of the mapping.
PLANS = ("Starter", "Growth", "Enterprise")
STAGES = (
    "closed_won", "Won", "QUALIFIED", None, "proposal", "Demo",
    "Lead", "Closed Lost", "Closed Won", "Proposal", "closed_lost", "Qualified",
)
CHURN_REASONS = (
    "Budget cuts", "No longer needed", "Poor support", "Price", "Switched to competitor",
)


#: Columns in use. With a given schema, reading starts no job to look into a file.
COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double,"
    " l_returnflag string, l_shipdate timestamp_ntz",
}


def _path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(_path(sf_dir, name))


def _pick(values: tuple[str | None, ...], key: str) -> str:
    texts = ", ".join("NULL" if value is None else f"'{value}'" for value in values)
    return f"array({texts})[int({key} % {len(values)})]"


def _customer_id(prefix: str, key: str) -> str:
    return f"concat('{prefix}', lpad({key}, greatest(6, length({key})), '0')) AS customer_id"


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = "date_add(DATE '2024-01-01', int(c_custkey % 366))"
    customer, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    return (
        customer.where("c_custkey % 10 <> 9")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            _customer_id("CUST-", "c_custkey"),
            "c_name AS company_name",
            "c_mktsegment AS industry",
            "n_name AS city",
            f"{_pick(PLANS, 'c_custkey')} AS plan",
            f"{_pick(STAGES, 'c_custkey')} AS pipeline_stage",
            f"""CASE WHEN c_custkey % 97 = 0 THEN date_format({signup}, 'yyyy.MM.dd')
                WHEN c_custkey % 9 = 0 THEN date_format({signup}, 'dd/MM/yyyy')
                ELSE date_format({signup}, 'yyyy-MM-dd') END AS signup_date""",
            "concat('AM-', c_custkey % 5 + 1) AS account_manager",
        )
    )


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    # Each task sorts its part of both, here and for whatever is found out about billing rows.
    raise_partitions(spark, _path(sf_dir, "orders"), _path(sf_dir, "lineitem"))
    # Both sides grow with the data, so neither is to be broadcast, however small it is in a test.
    return lineitem.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey")).selectExpr(
        "concat_ws('-', 'TX', l_orderkey, l_linenumber) AS transaction_id",
        _customer_id("C", "o_custkey"),
        f"CAST(l_extendedprice AS {schemas.MONEY.simpleString()}) AS amount",
        "CAST(l_shipdate AS date) AS transaction_date",
        "if(l_returnflag = 'R', 'refunded', 'paid') AS status",
        f"{_pick(PLANS, 'o_orderkey')} AS plan",
    )


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "date_add(DATE '1998-01-01', int(c_custkey % 900))"
    return (
        _table(spark, sf_dir, "customer")
        .where("c_custkey % 6 = 0")
        .selectExpr(
            _customer_id("CUST-", "c_custkey"),
            f"date_format({day}, 'yyyy-MM-dd') AS churn_date",
            f"{_pick(CHURN_REASONS, 'c_custkey')} AS churn_reason",
        )
    )


def extracts(spark: SparkSession, sf_dir: str) -> LazyTables:
    return LazyTables(
        {
            schemas.CRM: lambda: crm(spark, sf_dir),
            schemas.BILLING: lambda: billing(spark, sf_dir),
            schemas.CHURN: lambda: churn(spark, sf_dir),
        }
    )
