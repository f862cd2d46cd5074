"""Data quality: what is wrong in the extracts, and what cleaning them changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.functions import dates, ids, labels, money, stages
from ledgermill.operators.copies import all_copies
from ledgermill.operators.profiles import preview, profile_entries, value_counts
from ledgermill.operators.skew import HOT_ROWS
from ledgermill.plans.silver import COPY_ORDER, PAID
from ledgermill.sources.extracts import MALFORMED

# The status of money returned, and the length of the previews.
REFUNDED = "refunded"
PREVIEW_ROWS = 10
REFUND_PREVIEW_ROWS = 5


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Bronze validation


def crm_validation(crm: DataFrame) -> DataFrame:
    """Totals of bronze CRM, from one row per customer instead of a distinct count."""
    return (
        crm.groupBy("customer_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("signup_date").isNull()).alias("no_date"),
            F.count_if(F.col("pipeline_stage").isNull()).alias("no_stage"),
        )
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count("customer_id").alias("unique_customers"),
            F.sum("no_date").alias("null_dates"),
            F.sum("no_stage").alias("null_stages"),
        )
    )


def billing_validation(billing: DataFrame) -> DataFrame:
    """Totals of bronze billing. The two distinct counts read different columns, so each gets its
    own grouping; together they would send every row through the shuffle once more."""
    by_transaction = (
        billing.groupBy("transaction_id")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count("transaction_id").alias("unique_transactions"),
            F.lit(0).cast("bigint").alias("unique_customers"),
            F.sum("amount").alias("gross_amount_incl_refunds"),
        )
    )
    by_customer = (
        billing.select("customer_id")
        .distinct()
        .agg(
            F.lit(0).cast("bigint").alias("total_rows"),
            F.lit(0).cast("bigint").alias("unique_transactions"),
            F.count("customer_id").alias("unique_customers"),
            F.lit(None).cast("decimal(12,2)").alias("gross_amount_incl_refunds"),
        )
    )
    both = by_transaction.unionByName(by_customer)
    return both.agg(*(F.sum(name).alias(name) for name in both.columns))


def load_report(crm: DataFrame, billing: DataFrame, churn: DataFrame) -> DataFrame:
    """Rows of the bronze tables, and CRM dates that did not parse."""
    none = F.lit(0).cast("bigint")
    return _union(
        [
            df.agg(F.count("*").alias("n_rows"), nulls.alias("null_signup_dates")).select(
                F.lit(name).alias("table_name"), "n_rows", "null_signup_dates"
            )
            for name, df, nulls in (
                ("bronze_crm_customers", crm, F.count_if(F.col("signup_date").isNull())),
                ("bronze_billing_transactions", billing, none),
                ("bronze_churn", churn, none),
            )
        ]
    )


# Facts: one row for each extract, from one pass, that the single checks are taken from


def _malformed(df: DataFrame):
    return F.col(MALFORMED) if MALFORMED in df.columns else F.lit(False)


def _fields(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name != MALFORMED]


def _unparsed(df: DataFrame, column: str, parsed):
    return F.count_if(F.col(column).isNotNull() & parsed.isNull())


def crm_facts(crm: DataFrame) -> DataFrame:
    """Counts of the CRM extract as it came."""
    stage, signup = F.col("pipeline_stage"), F.col("signup_date")
    return crm.agg(
        F.count("*").alias("crm_rows"),
        F.count_if(stage.isNull()).alias("crm_null_stages"),
        F.count_if(stages.is_nonstandard(stage)).alias("crm_nonstandard_stages"),
        F.count_if(_not_iso(crm)).alias("crm_nonstandard_dates"),
        _unparsed(crm, "signup_date", dates.signup_date(signup)).alias("crm_unparsed_dates"),
        F.count_if(ids.violates(F.col("customer_id"), ids.CRM_ID)).alias("crm_id_violations"),
        F.count_if(_malformed(crm)).alias("crm_malformed_lines"),
        *(F.count(name).alias(f"has_{name}") for name in _fields(crm)),
    )


def churn_facts(churn: DataFrame) -> DataFrame:
    """Counts of the churn extract as it came."""
    parsed = dates.coerced_date(churn, "churn_date")
    return churn.agg(
        F.count("*").alias("churn_rows"),
        _unparsed(churn, "churn_date", parsed).alias("churn_unparsed_dates"),
        F.count_if(ids.violates(F.col("customer_id"), ids.CRM_ID)).alias("churn_id_violations"),
        F.count_if(_malformed(churn)).alias("churn_malformed_lines"),
        *(F.count(name).alias(f"has_{name}") for name in _fields(churn)),
    )


def billing_facts(billing: DataFrame) -> DataFrame:
    """Counts and sums of the billing extract as it came, all from one grouping by transaction.

    Amounts and dates are parsed here, so a bad one is a count and a missing value, not an error.
    The first copy of a transaction is the smallest row in the copy order. As a minimum it needs no
    pass of its own; it is no hash aggregate, though: each task sorts its rows by transaction.
    """
    amount, day = money.coerced_money(billing, "amount"), dates.coerced_date(billing, "transaction_date")
    rows = billing.select(
        *(name for name in billing.columns if name not in ("amount", "transaction_date")),
        amount.alias("amount"),
        day.alias("transaction_date"),
        money.is_bad_money(billing, "amount").alias("bad_amount"),
        (F.col("transaction_date").isNotNull() & day.isNull()).alias("bad_date"),
        *(F.col(c).isNotNull().alias(f"there_{c}") for c in ("amount", "transaction_date")),
    )
    there = {c: F.count_if(F.col(f"there_{c}")) for c in ("amount", "transaction_date")}
    paid, refunded = F.col("status") == PAID, F.col("status") == REFUNDED
    by_transaction = rows.groupBy("transaction_id").agg(
        F.count("*").alias("n"),
        F.count_if(ids.violates(F.col("customer_id"), ids.BILLING_ID)).alias("violations"),
        F.count_if(refunded).alias("refunds"),
        F.sum(F.when(refunded, F.col("amount"))).alias("refunded"),
        F.count_if(F.col("bad_amount")).alias("bad_amounts"),
        F.count_if(F.col("bad_date")).alias("bad_dates"),
        F.count_if(_malformed(billing)).alias("malformed"),
        F.sum("amount").alias("gross"),
        F.sum(F.when(paid, F.col("amount"))).alias("paid"),
        F.min(F.struct(*COPY_ORDER)).alias("first"),
        *(there.get(c, F.count(c)).alias(f"has_{c}") for c in _fields(billing)),
    )
    repeated, first_is_paid = F.col("n") > 1, F.col("first.status") == PAID
    sums = {
        "billing_rows": F.col("n"),
        "billing_id_violations": F.col("violations"),
        "billing_refund_rows": F.col("refunds"),
        "billing_duplicate_rows": F.when(repeated, F.col("n")),
        "billing_bad_amounts": F.col("bad_amounts"),
        "billing_unparsed_dates": F.col("bad_dates"),
        "billing_malformed_lines": F.col("malformed"),
        "refund_amount": F.col("refunded"),
        "gross_amount": F.col("gross"),
        "paid_amount": F.col("paid"),
        "paid_amount_without_copies": F.when(first_is_paid, F.col("first.amount")),
        **{f"has_{c}": F.col(f"has_{c}") for c in _fields(billing)},
    }
    return by_transaction.agg(
        F.count(F.when(repeated, F.col("transaction_id"))).alias("billing_duplicated_ids"),
        *(F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in sums.items()),
    )


# Shapes and profiles

#: Counts that make up a shape.
_ROWS = {"crm": "crm_rows", "billing": "billing_rows", "churn": "churn_rows"}


def shapes_of(facts: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each extract, from its facts."""
    return _union(
        [
            facts[table].select(
                F.lit(table).alias("table_name"),
                F.col(rows).alias("n_rows"),
                F.lit(sum(c.startswith("has_") for c in facts[table].columns)).cast("bigint").alias("n_columns"),
            )
            for table, rows in _ROWS.items()
        ]
    )


def profiles_of(facts: dict[str, DataFrame], types: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """Non-null values of every column of the extracts, with the types that they came in."""
    return _union(
        [
            facts[table].select(
                F.lit(table).alias("table_name"),
                F.inline(profile_entries(types[table], lambda c: F.col(f"has_{c}"))),
            )
            for table in _ROWS
        ]
    )


def _facts(crm: DataFrame, billing: DataFrame, churn: DataFrame) -> dict[str, DataFrame]:
    return {"crm": crm_facts(crm), "billing": billing_facts(billing), "churn": churn_facts(churn)}


def table_shapes(crm: DataFrame, billing: DataFrame, churn: DataFrame) -> DataFrame:
    return shapes_of(_facts(crm, billing, churn))


def column_profiles(crm: DataFrame, billing: DataFrame, churn: DataFrame) -> DataFrame:
    """Of the extracts as they came: a value that does not parse is there all the same."""
    found = {"crm": crm, "billing": billing, "churn": churn}
    types = {t: [(c, k) for c, k in df.dtypes if c != MALFORMED] for t, df in found.items()}
    return profiles_of(_facts(crm, billing, churn), types)


def crm_value_counts(crm: DataFrame) -> DataFrame:
    return value_counts(crm, ["industry", "plan", "pipeline_stage"])


def billing_value_counts(billing: DataFrame) -> DataFrame:
    return value_counts(billing, ["status", "plan"])


def churn_reason_counts(churn: DataFrame) -> DataFrame:
    return (
        churn.where(F.col("churn_reason").isNotNull())
        .groupBy("churn_reason")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "churn_reason")
    )


# Single checks


def null_stage_rows(crm: DataFrame) -> DataFrame:
    return crm.where(F.col("pipeline_stage").isNull())


def nonstandard_stages(crm: DataFrame) -> DataFrame:
    return (
        crm.where(stages.is_nonstandard(F.col("pipeline_stage")))
        .groupBy("pipeline_stage")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "pipeline_stage")
    )


def _not_iso(crm: DataFrame):
    return dates.coerced_date(crm, "signup_date").isNull()


def nonstandard_dates(crm: DataFrame) -> DataFrame:
    """Signup dates, as written, that are not ISO dates."""
    return crm.where(_not_iso(crm)).select("customer_id", "signup_date")


def violations_of(facts: dict[str, DataFrame]) -> DataFrame:
    """Rows per table whose customer id does not have the format of its system."""
    return _union(
        [
            facts[table].select(
                F.lit(table).alias("table_name"), F.col(f"{table}_id_violations").alias("violations")
            )
            for table in _ROWS
        ]
    )


def id_format_violations(crm: DataFrame, billing: DataFrame, churn: DataFrame) -> DataFrame:
    return violations_of(_facts(crm, billing, churn))


def duplicate_transactions(billing: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All copies of every transaction id that occurs more than once."""
    return all_copies(billing, "transaction_id", hot_rows)


def duplicate_transactions_top(billing: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The first few of them, by id."""
    return top_of(duplicate_transactions(billing, hot_rows))


def top_of(copies: DataFrame) -> DataFrame:
    return preview(copies, ("transaction_id", *COPY_ORDER), PREVIEW_ROWS)


def duplicates_of(facts: DataFrame) -> DataFrame:
    return facts.select(
        F.col("billing_duplicate_rows").alias("rows_involved"),
        F.col("billing_duplicated_ids").alias("duplicated_ids"),
    )


def duplicate_summary(billing: DataFrame) -> DataFrame:
    return duplicates_of(billing_facts(billing))


def refunds(billing: DataFrame) -> DataFrame:
    return billing.where(F.col("status") == REFUNDED)


def refunds_of(facts: DataFrame) -> DataFrame:
    return facts.select(
        F.col("billing_refund_rows").alias("refund_rows"),
        "refund_amount",
        labels.money(F.col("refund_amount"), 2).alias("refund_label"),
    )


def refund_summary(billing: DataFrame) -> DataFrame:
    return refunds_of(billing_facts(billing))


def ladder_of(facts: DataFrame) -> DataFrame:
    """Gross, paid, and paid without copies."""
    return facts.select("gross_amount", "paid_amount", "paid_amount_without_copies")


def revenue_ladder(billing: DataFrame) -> DataFrame:
    return ladder_of(billing_facts(billing))


def revenue_ladder_labels(ladder: DataFrame) -> DataFrame:
    return ladder.select(*(labels.money(F.col(name), 2).alias(name) for name in ladder.columns))


def billed_ids(billing: DataFrame) -> DataFrame:
    """Customer ids that billing has, each once."""
    return billing.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()


def billing_only_customers(billing: DataFrame, crm: DataFrame) -> DataFrame:
    """Billed customers the CRM does not know. Both sides are distinct before they meet; `billing`
    may be what `billed_ids` gives of it."""
    billed = billed_ids(billing).select(
        ids.to_crm_id_everywhere(F.col("customer_id")).alias("customer_id")
    )
    known = crm.select("customer_id").distinct()
    return billed.join(known, "customer_id", "left_anti").orderBy("customer_id")


def flagged_customers(silver_customers: DataFrame) -> DataFrame:
    """The same from silver: rows that carry the flag."""
    return silver_customers.where("billing_only_flag")


#: Counters of the report, by the facts they stand in.
COUNTERS = {
    "crm": (
        "crm_rows", "crm_null_stages", "crm_nonstandard_stages", "crm_nonstandard_dates",
        "crm_unparsed_dates", "crm_id_violations", "crm_malformed_lines",
    ),
    "billing": (
        "billing_rows", "billing_id_violations", "billing_refund_rows", "billing_duplicate_rows",
        "billing_duplicated_ids", "billing_bad_amounts", "billing_unparsed_dates",
        "billing_malformed_lines",
    ),
    "churn": ("churn_rows", "churn_unparsed_dates", "churn_id_violations", "churn_malformed_lines"),
}


def report_of(facts: dict[str, DataFrame], billing_only: DataFrame) -> DataFrame:
    """All counters as (check_name, n)."""
    counts = [facts[table].select(*names) for table, names in COUNTERS.items()]
    counts.append(billing_only.agg(F.count("*").alias("billing_only_customers")))
    return _union([df.na.fill(0).unpivot([], df.columns, "check_name", "n") for df in counts])


def dq_report(crm: DataFrame, billing: DataFrame, churn: DataFrame) -> DataFrame:
    """All counters of the extracts as they came: one pass each, and one for billing-only customers."""
    return report_of(_facts(crm, billing, churn), billing_only_customers(billing, crm))


# Previews


def billing_firsts(billing: DataFrame) -> DataFrame:
    """What both previews of billing are taken from, in one pass: the first rows of refunds and of all
    others. Every task keeps only as many of each."""
    is_refund = F.coalesce(F.col("status") == REFUNDED, F.lit(False))
    order = Window.partitionBy("is_refund").orderBy(*billing.columns)
    rows = billing.withColumn("is_refund", is_refund).withColumn("place", F.row_number().over(order))
    return rows.where(F.col("place") <= PREVIEW_ROWS).drop("is_refund", "place")


def crm_sample(crm: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return preview(crm, crm.columns, n)


def billing_sample(billing: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return preview(billing, billing.columns, n)


def churn_sample(churn: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return preview(churn, churn.columns, n)


def refund_sample(billing: DataFrame, n: int = REFUND_PREVIEW_ROWS) -> DataFrame:
    return preview(refunds(billing), billing.columns, n)
