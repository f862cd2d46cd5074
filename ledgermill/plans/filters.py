"""What a report is asked for, and how that narrows the tables."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import dates

# Modes and customer states a report can be asked for.
RAW, CLEAN = "raw", "clean"
ALL, ACTIVE, CHURNED = "all", "active", "churned"


@dataclass(frozen=True)
class MetricFilter:
    """``None`` puts no bound on a field. An empty list of plans or industries selects no rows.
    Date bounds are inclusive. Industries only count in clean mode: raw billing ids do not join."""

    mode: str = RAW
    plans: tuple[str, ...] | None = None
    start_date: datetime.date | None = None
    end_date: datetime.date | None = None
    industries: tuple[str, ...] | None = None
    status: str = ALL

    def __post_init__(self) -> None:
        if self.mode not in (RAW, CLEAN):
            raise ValueError(f"mode is {self.mode!r}, not {RAW!r} or {CLEAN!r}")
        if self.status not in (ALL, ACTIVE, CHURNED):
            raise ValueError(f"status is {self.status!r}, not {ALL!r}, {ACTIVE!r} or {CHURNED!r}")


def _in_list(column: Column, values: tuple[str, ...] | None) -> Column:
    if values is None:
        return column.isNotNull()
    return column.isin(*values) if values else F.lit(False)


def transactions_in_scope(transactions: DataFrame, f: MetricFilter) -> DataFrame:
    """Plan and date bounds. They are plain predicates on stored columns, so they reach the scan;
    on a table partitioned by month, date bounds also skip whole months."""
    kept = transactions.where(_in_list(F.col("plan"), f.plans))
    if f.mode == CLEAN and f.industries is not None and not f.industries:
        kept = kept.where(F.lit(False))
    by_month = "month" in transactions.columns
    if f.start_date is not None:
        kept = kept.where(F.col("transaction_date") >= F.lit(f.start_date))
        if by_month:
            kept = kept.where(F.col("month") >= dates.month_label(F.lit(f.start_date)))
    if f.end_date is not None:
        kept = kept.where(F.col("transaction_date") <= F.lit(f.end_date))
        if by_month:
            kept = kept.where(F.col("month") <= dates.month_label(F.lit(f.end_date)))
    return kept


def accounts_out_of_scope(accounts: DataFrame, f: MetricFilter) -> DataFrame:
    """Ids of CRM customers with no row in the industries.

    Leaving these out keeps the same customers as keeping those in the industries and those only
    billing knows, and does not need the customers that were billed.
    """
    in_scope = F.coalesce(_in_list(F.col("industry"), f.industries), F.lit(False))
    return (
        accounts.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.bool_or(in_scope).alias("in_scope"))
        .where(~F.col("in_scope"))
        .select("customer_id")
    )
