"""Columns and types of the three extracts and of the layer tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    StringType,
    StructField,
    StructType,
)

#: Exact money: sums do not depend on the order of the rows.
MONEY = DecimalType(12, 2)

CRM = "crm_customers"
BILLING = "billing_transactions"
CHURN = "churn_data"

_CRM_COLUMNS = (
    "customer_id",
    "company_name",
    "industry",
    "city",
    "plan",
    "pipeline_stage",
    "signup_date",
    "account_manager",
)
_BILLING_COLUMNS = (
    "transaction_id",
    "customer_id",
    "amount",
    "transaction_date",
    "status",
    "plan",
)
_CHURN_COLUMNS = ("customer_id", "churn_date", "churn_reason")


def _struct(columns: tuple[str, ...], **typed) -> StructType:
    return StructType([StructField(name, typed.get(name, StringType())) for name in columns])


#: Extracts arrive as text; the bronze plans type them and fail on what they cannot hold, the quality
#: checks count it, so a bad value is never lost silently.
EXTRACTS = {
    CRM: _struct(_CRM_COLUMNS),
    BILLING: _struct(_BILLING_COLUMNS),
    CHURN: _struct(_CHURN_COLUMNS),
}

BRONZE = {
    CRM: _struct(_CRM_COLUMNS, signup_date=DateType()),
    BILLING: _struct(_BILLING_COLUMNS, amount=MONEY, transaction_date=DateType()),
    CHURN: _struct(_CHURN_COLUMNS, churn_date=DateType()),
}

SILVER = {
    CRM: _struct(
        (
            "customer_id",
            "company_name",
            "industry",
            "city",
            "plan",
            "signup_date",
            "account_manager",
            "pipeline_stage",
            "billing_only_flag",
        ),
        signup_date=DateType(),
        billing_only_flag=BooleanType(),
    ),
    # ``month`` is the partition column, so it comes last.
    BILLING: _struct(
        (*_BILLING_COLUMNS, "month"), amount=MONEY, transaction_date=DateType()
    ),
    CHURN: BRONZE[CHURN],
}
