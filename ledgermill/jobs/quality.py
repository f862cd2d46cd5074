"""Quality checks of the extracts, each written as a table.

Dirt is what the job is for, so nothing in an extract fails it: what does not parse is missing and
counted. Most checks follow from the facts, one row for each extract, which are written first and read
back. Billing is scanned seven times: for facts, ids, value counts, firsts, filter choices, and twice
for repeated transactions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import ids
from ledgermill.plans import bronze, metrics, quality, silver
from ledgermill.schemas import BILLING, CHURN, CRM, EXTRACTS
from ledgermill.sources.extracts import MALFORMED, MARK, null_missing, read_extracts
from ledgermill.sources.layers import write_table

Stored = Callable[[str], DataFrame]


def _from_extracts(extracts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables that read an extract."""
    crm, billing, churn = (extracts[name].drop(MALFORMED) for name in (CRM, BILLING, CHURN))
    parsed = bronze.raw_billing(billing)
    return {
        "crm_facts": quality.crm_facts(extracts[CRM]),
        "billing_facts": quality.billing_facts(extracts[BILLING]),
        "churn_facts": quality.churn_facts(extracts[CHURN]),
        "crm_value_counts": quality.crm_value_counts(crm),
        "billing_value_counts": quality.billing_value_counts(billing),
        "churn_reason_counts": quality.churn_reason_counts(churn),
        "nonstandard_stages": quality.nonstandard_stages(crm),
        "nonstandard_dates": quality.nonstandard_dates(crm),
        "null_stage_rows": quality.null_stage_rows(crm),
        "duplicate_transactions": quality.duplicate_transactions(parsed),
        "billed_ids": quality.billed_ids(billing),
        "billing_firsts": quality.billing_firsts(parsed),
        "sample_crm": quality.crm_sample(crm),
        "sample_churn": quality.churn_sample(churn),
    }


def _from_tables(extracts: dict[str, DataFrame], stored: Stored) -> dict[str, DataFrame]:
    """Tables that follow from those written before."""
    crm, billing = (extracts[name].drop(MALFORMED) for name in (CRM, BILLING))
    facts = {name: stored(f"{name}_facts") for name in ("crm", "billing", "churn")}
    types = {
        table: [(field.name, "string") for field in EXTRACTS[name]]
        for table, name in (("crm", CRM), ("billing", BILLING), ("churn", CHURN))
    }
    billing_only = quality.billing_only_customers(stored("billed_ids"), crm)
    known = stored("billed_ids").select(ids.to_crm_id(F.col("customer_id")).alias("customer_id"))
    accounts = crm.select("customer_id", "industry").join(known, "customer_id", "left_semi")
    transactions = silver.transactions(bronze.raw_billing(billing))
    ladder = quality.ladder_of(facts["billing"])
    return {
        "billing_only_customers": billing_only,
        "dq_report": quality.report_of(facts, billing_only),
        "table_shapes": quality.shapes_of(facts),
        "column_profile": quality.profiles_of(facts, types),
        "id_format_violations": quality.violations_of(facts),
        "duplicate_summary": quality.duplicates_of(facts["billing"]),
        "duplicate_transactions_top": quality.top_of(stored("duplicate_transactions")),
        "refund_summary": quality.refunds_of(facts["billing"]),
        "revenue_ladder": ladder,
        "revenue_ladder_labels": quality.revenue_ladder_labels(ladder),
        "sample_billing": quality.billing_sample(stored("billing_firsts")),
        "sample_refunds": quality.refund_sample(stored("billing_firsts")),
        "filter_options": metrics.filter_options(transactions, accounts),
    }


def run(spark: SparkSession, extracts_dir: str, out_dir: str) -> dict[str, dict[str, object]]:
    """Writes every check as a table of its name; returns rows written."""
    extracts = {
        name: null_missing(df) for name, df in read_extracts(spark, extracts_dir, MARK).items()
    }
    write = partial(write_table, folder=out_dir)
    found = {n: write(df, name=n) for n, df in _from_extracts(extracts).items()}
    tables = _from_tables(extracts, lambda name: spark.read.parquet(f"{out_dir}/{name}"))
    return found | {n: write(df, name=n) for n, df in tables.items()}
