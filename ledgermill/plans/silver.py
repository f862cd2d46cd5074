"""Silver: ids reconciled, copies and refunds removed, stages standardised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import dates, ids, stages
from ledgermill.operators.copies import first_copy
from ledgermill.operators.skew import HOT_ROWS, left_join_spread

#: Which copy of a transaction is the first: the earliest. The rest settles ties, so that copies
#: which differ give the same survivor on every run.
COPY_ORDER = ("transaction_date", "status", "amount", "customer_id", "plan")

PAID = "paid"


def _payers(billing: DataFrame) -> DataFrame:
    """Billed (customer, plan) pairs. Ids are rewritten on the pairs, not on every transaction."""
    pairs = billing.select("customer_id", "plan").distinct()
    return pairs.select(
        ids.to_crm_id(F.col("customer_id")).alias("customer_id"), F.col("plan").alias("billed_plan")
    )


def customers(billing: DataFrame, crm: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per billed (customer, plan) and CRM row of that customer; CRM columns are NULL and
    ``billing_only_flag`` is set where the CRM does not know the customer.

    Billing drives: CRM customers that were never billed are not in the result. The plan is the
    CRM's, the billed one only stands in for a missing one.
    """
    payers = _payers(billing)
    accounts = crm.withColumn("pipeline_stage", stages.standard_stage(F.col("pipeline_stage")))
    return left_join_spread(payers, accounts, "customer_id", hot_rows).select(
        "customer_id",
        "company_name",
        "industry",
        "city",
        F.coalesce("plan", "billed_plan").alias("plan"),
        "signup_date",
        "account_manager",
        "pipeline_stage",
        (~F.col("matched")).alias("billing_only_flag"),
    )


def stage_counts(billing: DataFrame, crm: DataFrame) -> DataFrame:
    """(customer_id, stage, n): rows that `customers` has per customer and stage, where it has one.

    Both sides are counted before the join, so it never meets a customer with many CRM rows.
    """
    plans = _payers(billing).groupBy("customer_id").agg(F.count("*").alias("plans"))
    stage = stages.standard_stage(F.col("pipeline_stage")).alias("stage")
    accounts = crm.groupBy("customer_id", stage).agg(F.count("*").alias("accounts"))
    return accounts.join(plans, "customer_id").select(
        "customer_id", "stage", (F.col("plans") * F.col("accounts")).alias("n")
    )


def transactions(billing: DataFrame) -> DataFrame:
    """Paid transactions, one per transaction id.

    The status is looked at after the copies are gone: an id whose first copy is a refund has no
    row. Ids are rewritten last, on the rows that are left.
    """
    return (
        first_copy(billing, "transaction_id", COPY_ORDER)
        .where(F.col("status") == PAID)
        .withColumn("customer_id", ids.to_crm_id(F.col("customer_id")))
    )


def with_month(transactions: DataFrame) -> DataFrame:
    """Adds the month label, the partition column of the written table."""
    return transactions.withColumn("month", dates.month_label(F.col("transaction_date")))


def churn(bronze_churn: DataFrame) -> DataFrame:
    return bronze_churn.select("*")
