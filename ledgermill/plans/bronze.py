"""Bronze: the extracts with typed columns and nothing else changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import dates, money


def crm(extract: DataFrame) -> DataFrame:
    """Signup dates come in two formats; a date in neither is NULL."""
    return extract.withColumn("signup_date", dates.signup_date(F.col("signup_date")))


def billing(extract: DataFrame) -> DataFrame:
    """A bad date fails the job, and so does an amount that the money type cannot hold exactly."""
    return extract.withColumns(
        {
            "amount": money.strict_money(extract, "amount"),
            "transaction_date": dates.strict_date(extract, "transaction_date"),
        }
    )


def churn(extract: DataFrame) -> DataFrame:
    return extract.withColumn("churn_date", dates.strict_date(extract, "churn_date"))


def raw_billing(extract: DataFrame) -> DataFrame:
    """Billing as the raw mode shows it: no cleaning, a bad date or amount is NULL, not an error."""
    return extract.withColumns(
        {
            "amount": money.coerced_money(extract, "amount"),
            "transaction_date": dates.coerced_date(extract, "transaction_date"),
        }
    )
