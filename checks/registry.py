"""Every query of the library over the tables of one scale folder."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgermill.functions import ids
from ledgermill.plans import metrics, quality, tables
from ledgermill.plans.filters import MetricFilter
from ledgermill.schemas import BILLING, CHURN, CRM
from ledgermill.sources import harness

Query = Callable[[SparkSession, str], DataFrame]

#: Filters of the registered reports; the SQL is written from the same values.
FILTERS = {
    "clean": MetricFilter(mode="clean"),
    "clean_active": MetricFilter(mode="clean", status="active"),
    "clean_churned": MetricFilter(mode="clean", status="churned"),
    "clean_plan": MetricFilter(mode="clean", plans=("Growth",)),
    "clean_industry": MetricFilter(mode="clean", industries=("MACHINERY",)),
    "clean_dates": MetricFilter(
        mode="clean",
        start_date=datetime.date(1997, 4, 1),
        end_date=datetime.date(1999, 6, 30),
    ),
    "clean_filtered": MetricFilter(
        mode="clean",
        plans=("Growth", "Enterprise"),
        start_date=datetime.date(1997, 4, 1),
        end_date=datetime.date(1999, 6, 30),
        industries=("BUILDING", "AUTOMOBILE"),
        status="active",
    ),
    "clean_empty": MetricFilter(mode="clean", plans=()),
    "clean_no_industry": MetricFilter(mode="clean", industries=()),
    "raw": MetricFilter(mode="raw"),
    "raw_active": MetricFilter(mode="raw", status="active"),
    "raw_churned": MetricFilter(mode="raw", status="churned"),
    "raw_plan": MetricFilter(mode="raw", plans=("Growth",)),
    "raw_dates": MetricFilter(
        mode="raw",
        start_date=datetime.date(1997, 4, 1),
        end_date=datetime.date(1999, 6, 30),
    ),
}


def _plain(df: DataFrame) -> DataFrame:
    """Money as double, the type both engines report alike; it was summed as decimal."""
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in money}) if money else df


class Tables:
    """The tables of one scale folder, each built when a query first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.raw = harness.extracts(spark, sf_dir)

    @cached_property
    def text(self) -> dict[str, DataFrame]:
        """The extracts as a CSV file gives them: every column is text."""
        return {
            name: self.raw[name].select(*(F.col(c).cast("string") for c in self.raw[name].columns))
            for name in (CRM, BILLING, CHURN)
        }

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return tables.bronze_tables(self.raw)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return tables.silver_tables(self.bronze)

    @cached_property
    def accounts(self) -> DataFrame:
        """CRM customers that billing has."""
        billed = quality.billed_ids(self.bronze[BILLING])
        known = billed.select(ids.to_crm_id(F.col("customer_id")).alias("customer_id"))
        crm = self.bronze[CRM].select("customer_id", "industry")
        return crm.join(known, "customer_id", "left_semi")

    def relations(self, name: str) -> metrics.Relations:
        if FILTERS[name].mode == "raw":
            return tables.raw_relations(self.raw)
        return tables.clean_relations(self.bronze)

    def activity(self, name: str, *by: str) -> DataFrame:
        return metrics.activity(self.relations(name), FILTERS[name], by)

    def cohorts(self, name: str) -> DataFrame:
        return metrics.cohorts(self.activity(name))

    def stage_distribution(self, name: str) -> DataFrame:
        relations, f = self.relations(name), FILTERS[name]
        return metrics.stage_distribution(relations, f, metrics.activity(relations, f))

    def stored_stage_distribution(self, name: str) -> DataFrame:
        """The same through the relations of silver tables; these are built here, not stored."""
        relations, f = tables.stored_relations(self.silver), FILTERS[name]
        return metrics.stage_distribution(relations, f, metrics.activity(relations, f))

    def report(self, name: str) -> DataFrame:
        return metrics.report(self.relations(name), FILTERS[name])


_TABLE_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # Bronze
    "crm_bronze": lambda t: t.bronze[CRM],
    "billing_bronze": lambda t: t.bronze[BILLING],
    "churn_bronze": lambda t: t.bronze[CHURN],
    "load_report": lambda t: quality.load_report(
        t.bronze[CRM], t.bronze[BILLING], t.bronze[CHURN]
    ),
    "bronze_crm_validation": lambda t: quality.crm_validation(t.bronze[CRM]),
    "bronze_billing_validation": lambda t: quality.billing_validation(t.bronze[BILLING]),
    # Silver
    "silver_customers": lambda t: t.silver[CRM],
    "silver_transactions": lambda t: t.silver[BILLING],
    "silver_churn": lambda t: t.silver[CHURN],
    "flagged_customers": lambda t: quality.flagged_customers(t.silver[CRM]),
    "billing_only_customers": lambda t: quality.billing_only_customers(
        t.raw[BILLING], t.raw[CRM]
    ),
    # Data quality
    "dq_report": lambda t: quality.dq_report(t.text[CRM], t.text[BILLING], t.text[CHURN]),
    "table_shapes": lambda t: quality.table_shapes(t.raw[CRM], t.raw[BILLING], t.raw[CHURN]),
    "column_profile": lambda t: quality.column_profiles(
        t.text[CRM], t.text[BILLING], t.text[CHURN]
    ),
    "crm_value_counts": lambda t: quality.crm_value_counts(t.raw[CRM]),
    "billing_value_counts": lambda t: quality.billing_value_counts(t.raw[BILLING]),
    "null_stage_rows": lambda t: quality.null_stage_rows(t.raw[CRM]),
    "nonstandard_stages": lambda t: quality.nonstandard_stages(t.raw[CRM]),
    "nonstandard_dates": lambda t: quality.nonstandard_dates(t.raw[CRM]),
    "id_format_violations": lambda t: quality.id_format_violations(
        t.raw[CRM], t.raw[BILLING], t.raw[CHURN]
    ),
    "duplicate_transactions": lambda t: quality.duplicate_transactions(t.raw[BILLING]),
    "duplicate_transactions_top10": lambda t: quality.duplicate_transactions_top(t.raw[BILLING]),
    "duplicate_summary": lambda t: quality.duplicate_summary(t.raw[BILLING]),
    "refund_summary": lambda t: quality.refund_summary(t.raw[BILLING]),
    "revenue_ladder": lambda t: quality.revenue_ladder(t.raw[BILLING]),
    "revenue_ladder_labels": lambda t: quality.revenue_ladder_labels(
        quality.revenue_ladder(t.raw[BILLING])
    ),
    "churn_reason_counts": lambda t: quality.churn_reason_counts(t.raw[CHURN]),
    "sample_rows": lambda t: quality.crm_sample(t.raw[CRM]),
    "sample_billing": lambda t: quality.billing_sample(t.raw[BILLING]),
    "sample_churn": lambda t: quality.churn_sample(t.raw[CHURN]),
    "sample_refunds": lambda t: quality.refund_sample(t.raw[BILLING]),
    # Report
    "kpi_labels": lambda t: metrics.kpi_labels(metrics.kpis(t.cohorts("clean"))),
    "filter_options": lambda t: metrics.filter_options(t.silver[BILLING], t.accounts),
}

#: Filters each part of the report is registered with.
KPI_FILTERS = tuple(FILTERS)
SERIES_FILTERS = ("clean", "clean_filtered", "raw", "raw_dates")
STORED_FILTERS = ("clean", "clean_filtered")
REPORT_FILTERS = ("clean", "clean_filtered", "clean_churned", "clean_empty", "raw")


def _report_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    found: dict[str, Callable[[Tables], DataFrame]] = {}
    for name in KPI_FILTERS:
        found[f"kpi_{name}"] = lambda t, n=name: metrics.kpis(t.cohorts(n))
    for name in SERIES_FILTERS:
        found[f"monthly_revenue_{name}"] = lambda t, n=name: metrics.monthly_revenue(
            t.activity(n, "month")
        )
        found[f"revenue_by_plan_{name}"] = lambda t, n=name: metrics.revenue_by_plan(
            t.activity(n, "plan")
        )
        found[f"new_customers_{name}"] = lambda t, n=name: metrics.new_customers(t.cohorts(n))
        found[f"stage_distribution_{name}"] = lambda t, n=name: t.stage_distribution(n)
    for name in STORED_FILTERS:
        found[f"stored_stage_distribution_{name}"] = (
            lambda t, n=name: t.stored_stage_distribution(n)
        )
    for name in REPORT_FILTERS:
        found[f"report_{name}"] = lambda t, n=name: t.report(n)
    return found


def queries() -> dict[str, Query]:
    return {
        name: lambda spark, sf_dir, plan=plan: _plain(plan(Tables(spark, sf_dir)))
        for name, plan in {**_TABLE_QUERIES, **_report_queries()}.items()
    }
