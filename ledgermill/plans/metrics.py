"""The report: three key figures and four series, for any `MetricFilter`.

Everything is computed from the *activity*: transactions summed per customer and whatever else a
figure is broken down by. Industry, churn and CRM stage are properties of customers, so they are
joined to the activity and never to transactions: the join input is combined on the map side first,
and a customer with a third of all transactions is a handful of rows by then.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.functions import dates, labels, rates
from ledgermill.operators.skew import semi_join_dealt
from ledgermill.plans import filters
from ledgermill.plans.filters import MetricFilter

#: Stands for "no customer". Transactions without one count as revenue and pass the industry filter
#: like any customer the CRM does not know, so they must survive joins; as a value they do, and the
#: joins stay plain equalities that use the partitioning of the grouping.
NO_CUSTOMER = "\0"


@dataclass(frozen=True)
class Relations:
    """What the report of one mode reads; `tables` puts them together.

    transactions: billing rows, cleaned or not
    churn: one row or more per churned customer_id
    accounts: (customer_id, industry) of customers the CRM knows; not read in raw mode
    stages: gives (customer_id, stage, n), the rows of the pipeline chart, to those parts that show
        it; in raw mode without customer_id. Rows with a stage have a customer: they are the CRM's.
    plans: (plan) that count if the filter names none; None for every plan there is
    """

    transactions: DataFrame
    churn: DataFrame
    accounts: DataFrame | None
    stages: Callable[[], DataFrame]
    plans: DataFrame | None = None


def raw_stages(crm: DataFrame) -> DataFrame:
    return crm.groupBy(F.col("pipeline_stage").alias("stage")).agg(F.count("*").alias("n"))


def silver_stages(silver_customers: DataFrame) -> DataFrame:
    stage = F.col("pipeline_stage").alias("stage")
    return silver_customers.groupBy("customer_id", stage).agg(F.count("*").alias("n"))


def _key() -> Column:
    return F.coalesce(F.col("customer_id"), F.lit(NO_CUSTOMER)).alias("customer_id")


def _summed(relations: Relations, f: MetricFilter, by: tuple[str, ...]) -> DataFrame:
    """Transactions within the bounds of plan and date, summed per customer and ``by``."""
    breakdown = {"plan": F.col("plan"), "month": dates.month_start(F.col("transaction_date"))}
    scope = filters.transactions_in_scope(relations.transactions, f)
    only_plans = f.plans is None and relations.plans is not None
    names = (*by, "plan") if only_plans and "plan" not in by else by
    summed = (
        scope.groupBy(_key(), *(breakdown[name].alias(name) for name in names))
        .agg(
            F.sum("amount").alias("amount"),
            F.min("transaction_date").alias("first_date"),
            F.count("*").alias("n_transactions"),
        )
    )
    if only_plans:
        # Plans are looked up for sums, not for transactions: which plans count is found out at the
        # same time as the sums, and neither waits for the other. Plans are few, so by plan alone
        # all sums would meet in a few tasks.
        summed = semi_join_dealt(summed, relations.plans, "plan", ("customer_id", *names))
        if names != by:
            summed = summed.groupBy("customer_id", *by).agg(
                F.sum("amount").alias("amount"),
                F.min("first_date").alias("first_date"),
                F.sum("n_transactions").alias("n_transactions"),
            )
    return summed


def activity(relations: Relations, f: MetricFilter, by: tuple[str, ...] = ()) -> DataFrame:
    """Filtered transactions per customer and ``by`` ("plan", "month"), with churn flag.

    Columns: customer_id, by..., amount, first_date, n_transactions, churned. With no ``by`` the
    grouping already partitions by customer, and the joins need no further shuffle of it.
    """
    summed = _summed(relations, f, by)
    if f.mode == filters.CLEAN:
        outside = filters.accounts_out_of_scope(relations.accounts, f)
        summed = summed.join(outside, "customer_id", "left_anti")
    left = relations.churn.select(_key()).distinct()
    if f.status == filters.ACTIVE:
        return summed.join(left, "customer_id", "left_anti").withColumn("churned", F.lit(False))
    if f.status == filters.CHURNED:
        return summed.join(left, "customer_id", "left_semi").withColumn("churned", F.lit(True))
    marked = summed.join(left.withColumn("mark", F.lit(True)), "customer_id", "left")
    return marked.withColumn("churned", F.coalesce("mark", F.lit(False))).drop("mark")


def per_customer(activity_: DataFrame) -> DataFrame:
    """Activity with any breakdown, summed up to one row per customer."""
    return activity_.groupBy("customer_id").agg(
        F.sum("amount").alias("amount"),
        F.min("first_date").alias("first_date"),
        F.sum("n_transactions").alias("n_transactions"),
        F.bool_or("churned").alias("churned"),
    )


def cohorts(customer_activity: DataFrame) -> DataFrame:
    """Customers by month of their first transaction and by churn, with what they paid.

    Input is one row per customer, so counting customers is plain counting. The result is small, and
    both the key figures and the new customers per month follow from it.
    """
    return customer_activity.groupBy(
        dates.month_start(F.col("first_date")).alias("month"),
        (F.col("customer_id") != NO_CUSTOMER).alias("known"),
        "churned",
    ).agg(
        F.count("*").alias("customers"),
        F.sum("amount").alias("amount"),
        F.sum("n_transactions").alias("n_transactions"),
    )


def _count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("customers"))), F.lit(0))


def kpis(cohorts_: DataFrame) -> DataFrame:
    """One row: revenue, active customers, churn rate, and what they are computed from."""
    known, churned = F.col("known"), F.col("churned")
    counted = cohorts_.agg(
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_revenue"),
        _count_where(known & ~churned).alias("active_customers"),
        _count_where(known).alias("unique_customers"),
        _count_where(churned).alias("churned_customers"),
        F.coalesce(F.sum("n_transactions"), F.lit(0)).alias("n_transactions"),
    )
    return counted.withColumn(
        "churn_rate", rates.percentage(F.col("churned_customers"), F.col("unique_customers"))
    )


def kpi_labels(kpis_: DataFrame) -> DataFrame:
    return kpis_.select(
        labels.money(F.col("total_revenue")).alias("total_revenue"),
        labels.count(F.col("active_customers")).alias("active_customers"),
        labels.percent(F.col("churn_rate")).alias("churn_rate"),
    )


def _revenue(activity_: DataFrame, by: str) -> DataFrame:
    return activity_.groupBy(by).agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("revenue"))


def _monthly_revenue(activity_: DataFrame) -> DataFrame:
    return _revenue(activity_, "month").withColumn("month", dates.month_label(F.col("month")))


def monthly_revenue(activity_: DataFrame) -> DataFrame:
    """Needs the breakdown "month"."""
    return _monthly_revenue(activity_).orderBy("month")


def _revenue_by_plan(activity_: DataFrame) -> DataFrame:
    return _revenue(activity_.where(F.col("plan").isNotNull()), "plan")


def revenue_by_plan(activity_: DataFrame) -> DataFrame:
    """Needs the breakdown "plan", which is the billed plan, not the CRM's."""
    return _revenue_by_plan(activity_).orderBy(F.desc("revenue"), "plan")


def _new_customers(cohorts_: DataFrame) -> DataFrame:
    return (
        cohorts_.where("known")
        .groupBy("month")
        .agg(F.sum("customers").alias("new_customers"))
        .withColumn("month", dates.month_label(F.col("month")))
    )


def new_customers(cohorts_: DataFrame) -> DataFrame:
    """Customers by the month of their first transaction among the filtered ones."""
    return _new_customers(cohorts_).orderBy("month")


def _stage_counts(relations: Relations, f: MetricFilter, customers: DataFrame) -> DataFrame:
    staged = relations.stages().where(F.col("stage").isNotNull())
    if f.mode == filters.CLEAN:
        staged = staged.join(customers.select("customer_id"), "customer_id", "left_semi")
    return staged.groupBy("stage").agg(F.sum("n").alias("customers"))


def stage_distribution(
    relations: Relations, f: MetricFilter, customers: DataFrame
) -> DataFrame:
    """CRM rows per stage, with their share. Clean mode counts the silver rows of the given
    customers; raw mode counts the whole CRM whatever the filter says."""
    return with_shares(_stage_counts(relations, f, customers)).orderBy(
        F.desc("customers"), "stage"
    )


#: Parts that stages are dealt to for their share; each holds some stages and the total.
_PARTS = 16


def with_shares(counts: DataFrame) -> DataFrame:
    """(stage, customers) with the share of all customers, from one execution of the counts.

    Every count goes to the part of its stage and, as a share of the total, to all parts. A total
    from a second use of the counts would run them twice, and a window over all of them would put
    all stages in one task, which in raw mode are as many as the CRM has spellings.
    """
    part = F.pmod(F.xxhash64("stage"), F.lit(_PARTS)).cast("int")
    entry = lambda part, stage: F.struct(part.alias("part"), stage.alias("stage"), F.col("customers").alias("n"))
    no_stage = F.lit(None).cast("string")
    entries = F.array(entry(part, F.col("stage")), *(entry(F.lit(i), no_stage) for i in range(_PARTS)))
    dealt = counts.select(F.inline(entries)).groupBy("part", "stage").agg(F.sum("n").alias("customers"))
    total = F.max(F.when(F.col("stage").isNull(), F.col("customers"))).over(Window.partitionBy("part"))
    return (
        dealt.withColumn("total", total)
        .where(F.col("stage").isNotNull())
        .select("stage", "customers", (F.col("customers") / F.col("total")).alias("share"))
    )


def filter_options(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """The choices a report offers, as (field, value): plans, industries and the date range.

    ``accounts`` are the customers (customer_id, industry) whose industries count: those the CRM
    knows and billing has, once or more. Transactions are read once: each plan's row carries its
    dates, and what is left to sort is one row per plan and industry.
    """
    entry = lambda field, value: F.struct(F.lit(field).alias("field"), value.alias("value"))
    date = F.col("transaction_date")
    by_plan = transactions.groupBy("plan").agg(
        F.min(date).cast("string").alias("date_min"), F.max(date).cast("string").alias("date_max")
    )
    rows = by_plan.select(
        F.inline(F.array(*(entry(c, F.col(c)) for c in ("plan", "date_min", "date_max"))))
    )
    industries = accounts.where(F.col("industry").isNotNull()).select(
        F.lit("industry").alias("field"), F.col("industry").alias("value")
    )
    # All plans and industries stay; of the dates the first and the last.
    is_date, last = F.col("field").isin("date_min", "date_max"), F.col("field") == "date_max"
    return (
        rows.unionByName(industries)
        .groupBy("field", F.when(~is_date, F.col("value")).alias("own"))
        .agg(F.min("value").alias("least"), F.max("value").alias("most"))
        .select("field", F.when(last, F.col("most")).otherwise(F.col("least")).alias("value"))
        .orderBy("field", "value")
    )


#: Parts of the whole report.
KPI = "kpi"
MONTHLY_REVENUE = "monthly_revenue"
REVENUE_BY_PLAN = "revenue_by_plan"
STAGE_DISTRIBUTION = "stage_distribution"
NEW_CUSTOMERS = "new_customers"

_VALUE = "decimal(32,2)"


def shares_of(report_: DataFrame) -> DataFrame:
    """Stages of a written report with their share of all: (stage, customers, share)."""
    rows = report_.where(F.col("part") == STAGE_DISTRIBUTION)
    total = rows.agg(F.sum("value")).scalar()
    return rows.select(
        F.col("label").alias("stage"),
        F.col("value").cast("bigint").alias("customers"),
        (F.col("value") / total).alias("share"),
    )


def texts_of(report_: DataFrame) -> DataFrame:
    """Key figures of a written report as the cards show them: (figure, text)."""
    value, figure = F.col("value"), F.col("label")
    text = F.when(figure == "total_revenue", labels.money(value)).when(
        figure == "churn_rate", labels.percent(value)
    )
    return report_.where(F.col("part") == KPI).select(
        figure.alias("figure"), text.otherwise(labels.count(value)).alias("text")
    )


def _digest(relations: Relations, f: MetricFilter) -> DataFrame:
    """Revenue and customers by everything the report is broken down by: a small table.

    What is known of a customer - its sums, whether it left, whether its industries count, its stages -
    comes as rows of one table with the customer's id, each kind combined per customer before. So one
    shuffle by customer and one window replace the joins: the window settles which row stands for the
    customer, when it came, and whether its rows count.
    """
    paid = _summed(relations, f, by=("plan", "month")).select(
        "customer_id", "plan", "month", "amount", "first_date", F.lit(True).alias("paid")
    )
    left = relations.churn.select(_key(), F.lit(True).alias("left"))
    parts = [paid, left.distinct()]
    if f.mode == filters.CLEAN:
        outside = filters.accounts_out_of_scope(relations.accounts, f)
        parts.append(outside.select("customer_id", F.lit(True).alias("outside")))
        staged = relations.stages().where(F.col("stage").isNotNull())
        parts.append(staged.select("customer_id", "stage", "n"))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)
    missing = {"outside": "boolean", "stage": "string", "n": "bigint"}
    together = together.withColumns(
        {c: F.lit(None).cast(kind) for c, kind in missing.items() if c not in together.columns}
    )
    order = [F.desc_nulls_last("paid"), "plan", "month", "stage"]
    customer = Window.partitionBy("customer_id").orderBy(*order)
    whole = customer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    churned = F.coalesce(F.max("left").over(whole), F.lit(False))
    status = {filters.ACTIVE: ~F.col("churned"), filters.CHURNED: F.col("churned")}
    digest = (
        together.withColumns(
            {
                "first_month": dates.month_start(F.min("first_date").over(whole)),
                "seen": F.max("paid").over(whole) & F.max("outside").over(whole).isNull(),
                "churned": churned,
                "stands": (F.row_number().over(customer) == 1).cast("int"),
            }
        )
        .where("seen")
        .where(F.col("paid") | F.col("stage").isNotNull())
        .where(status.get(f.status, F.lit(True)))
        .groupBy(
            F.coalesce("paid", F.lit(False)).alias("paid"),
            "plan",
            "month",
            "first_month",
            (F.col("customer_id") != NO_CUSTOMER).alias("known"),
            "churned",
            "stage",
        )
        .agg(
            F.sum("amount").alias("amount"),
            F.sum("stands").alias("customers"),
            F.sum("n").alias("n"),
        )
    )
    if f.mode == filters.CLEAN:
        return digest
    staged = relations.stages().where(F.col("stage").isNotNull())
    return digest.unionByName(
        staged.select("stage", "n", F.lit(False).alias("paid")), allowMissingColumns=True
    )


def report(relations: Relations, f: MetricFilter) -> DataFrame:
    """The whole report as (part, label, value), from one pass over the transactions.

    The functions for single parts each make their own pass. Spark does not share them: every part
    needs other columns, so their plans differ from the scan on.
    """
    known, churned = F.col("known"), F.col("churned")
    amount = F.coalesce("amount", F.lit(0)).cast(_VALUE)
    nothing = F.lit(0).cast(_VALUE)

    def customers(condition: Column | None = None) -> Column:
        n = F.col("customers") if condition is None else F.when(condition, F.col("customers"))
        return F.coalesce(n, F.lit(0)).cast(_VALUE)

    def entry(part: str, label: Column, value: Column, base: Column = nothing) -> Column:
        return F.struct(
            F.lit(part).alias("part"),
            label.alias("label"),
            value.alias("value"),
            base.alias("base"),
        )

    figures = {
        "total_revenue": (amount, nothing),
        "active_customers": (customers(known & ~churned), nothing),
        "churn_rate": (customers(churned), customers(known)),
    }
    paid_entries = F.array(
        *(entry(KPI, F.lit(name), *values) for name, values in figures.items()),
        entry(MONTHLY_REVENUE, dates.month_label(F.col("month")), amount),
        entry(REVENUE_BY_PLAN, F.col("plan"), amount),
        entry(NEW_CUSTOMERS, dates.month_label(F.col("first_month")), customers(known)),
    )
    stage_entries = F.array(entry(STAGE_DISTRIBUTION, F.col("stage"), F.col("n").cast(_VALUE)))
    entries = _digest(relations, f).select(
        F.inline(F.when(F.col("paid"), paid_entries).otherwise(stage_entries))
    )
    # The figures are there even if nothing passes the filter.
    zeros = F.array(*(entry(KPI, F.lit(name), nothing) for name in figures))
    entries = entries.unionByName(
        relations.transactions.sparkSession.range(1).select(F.inline(zeros))
    )
    summed = (
        entries.where(F.col("label").isNotNull())
        .groupBy("part", "label")
        .agg(F.sum("value").alias("value"), F.sum("base").alias("base"))
        # A month without a known newcomer is not in the series.
        .where((F.col("part") != NEW_CUSTOMERS) | (F.col("value") > 0))
    )
    value, base = F.col("value").cast("double"), F.col("base").cast("double")
    is_rate = (F.col("part") == KPI) & (F.col("label") == "churn_rate")
    shown = F.when(is_rate, rates.percentage(value, base)).otherwise(value)
    return summed.select("part", "label", shown.alias("value"))
