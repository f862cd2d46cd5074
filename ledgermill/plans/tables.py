"""Extracts to bronze to silver to what the report reads, as lazy tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ledgermill.plans import bronze, metrics, silver
from ledgermill.plans.metrics import Relations
from ledgermill.schemas import BILLING, CHURN, CRM
from ledgermill.sources.lazy import LazyTables


def bronze_tables(extracts: Mapping[str, DataFrame]) -> LazyTables:
    return LazyTables(
        {
            CRM: lambda: bronze.crm(extracts[CRM]),
            BILLING: lambda: bronze.billing(extracts[BILLING]),
            CHURN: lambda: bronze.churn(extracts[CHURN]),
        }
    )


def silver_tables(bronze_: Mapping[str, DataFrame]) -> LazyTables:
    return LazyTables(
        {
            CRM: lambda: silver.customers(bronze_[BILLING], bronze_[CRM]),
            BILLING: lambda: silver.transactions(bronze_[BILLING]),
            CHURN: lambda: silver.churn(bronze_[CHURN]),
        }
    )


def raw_relations(extracts: Mapping[str, DataFrame], every_plan: bool = False) -> Relations:
    """Raw-mode relations: extracts as they came. A filter without plans then takes those that
    cleaned transactions have, as it does in clean mode, or with ``every_plan`` any."""
    billing = bronze.raw_billing(extracts[BILLING])
    plans = None if every_plan else silver.transactions(billing).select("plan").distinct()
    return Relations(
        transactions=billing,
        plans=plans,
        churn=extracts[CHURN],
        accounts=None,
        stages=lambda: metrics.raw_stages(extracts[CRM]),
    )


def clean_relations(bronze_: Mapping[str, DataFrame]) -> Relations:
    """Clean-mode relations straight from bronze, for when silver is not written: billing is read
    for the transactions, and once more, two columns of it, only if the pipeline chart is asked for.
    """
    billing, crm = bronze_[BILLING], bronze_[CRM]
    return Relations(
        transactions=silver.transactions(billing),
        churn=bronze_[CHURN],
        accounts=crm,
        stages=lambda: silver.stage_counts(billing, crm),
    )


def stored_relations(silver_: Mapping[str, DataFrame]) -> Relations:
    """Clean-mode relations from written silver tables."""
    customers = silver_[CRM]
    return Relations(
        transactions=silver_[BILLING],
        churn=silver_[CHURN],
        accounts=customers.where("NOT billing_only_flag"),
        stages=lambda: metrics.silver_stages(customers),
    )
