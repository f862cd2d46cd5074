"""Customer ids: the CRM writes ``CUST-001`` where billing writes ``C001``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id formats of the source systems.
CRM_ID = r"^CUST-\d+$"
BILLING_ID = r"^C\d+$"
BILLING_PREFIX = "C"
CRM_PREFIX = "CUST-"


def to_crm_id(billing_id: Column) -> Column:
    """Leading ``C`` becomes ``CUST-``. Distinct ids stay distinct, so grouping can come first."""
    return F.regexp_replace(billing_id, f"^{BILLING_PREFIX}", CRM_PREFIX)


def to_crm_id_everywhere(billing_id: Column) -> Column:
    """Every ``C`` becomes ``CUST-``, for the quality checks; equal to `to_crm_id` on clean ids."""
    return F.replace(billing_id, F.lit(BILLING_PREFIX), F.lit(CRM_PREFIX))


def violates(customer_id: Column, pattern: str) -> Column:
    """True where the id does not have the format. A missing id does not have it either."""
    return ~F.coalesce(customer_id.rlike(pattern), F.lit(False))
