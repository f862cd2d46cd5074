"""Tiny extracts with one of every kind of dirt."""

from ledgermill import schemas

CRM_ROWS = [
    ("CUST-001", "Company 1", "Retail", "Toronto", "Starter", "closed_won", "23/11/2024", "AM-1"),
    ("CUST-002", "Company 2", "Finance", "Calgary", "Growth", None, "2024-02-27", "AM-2"),
    ("CUST-003", "Company 3", "Retail", "Calgary", "Growth", "QUALIFIED", "2024.03.01", "AM-2"),
    ("CUST-004", "Company 4", None, "Ottawa", None, "closed lost", "2024-03-02", "AM-1"),
    # Never billed.
    ("CUST-005", "Company 5", "Retail", "Ottawa", "Starter", "Demo", "2024-03-03", "AM-1"),
]
BILLING_ROWS = [
    # Exact copies.
    ("TX-1", "C001", "149", "2024-01-10", "paid", "Growth"),
    ("TX-1", "C001", "149", "2024-01-10", "paid", "Growth"),
    # Another plan of the same customer.
    ("TX-2", "C001", "49", "2024-02-10", "paid", "Starter"),
    # Copies of one id on one day: the paid one comes first.
    ("TX-3", "C002", "499", "2024-02-11", "refunded", "Enterprise"),
    ("TX-3", "C002", "499", "2024-02-11", "paid", "Enterprise"),
    # Copies on different days: the refund is earlier, so nothing is left.
    ("TX-4", "C002", "499", "2024-03-11", "refunded", "Enterprise"),
    ("TX-4", "C002", "499", "2024-03-12", "paid", "Enterprise"),
    # No date sorts before every date.
    ("TX-5", "C003", "49", None, "paid", "Starter"),
    ("TX-5", "C003", "51", "2024-03-13", "paid", "Starter"),
    ("TX-6", "C004", "149", "2024-03-14", "paid", "Growth"),
    # Not in the CRM.
    ("TX-7", "C009", "149", "2024-03-15", "paid", "Growth"),
    # An id that is in CRM format already.
    ("TX-8", "CUST-001", "49", "2024-03-16", "paid", "Starter"),
    # No customer.
    ("TX-9", None, "10", "2024-03-17", "paid", "Starter"),
    ("TX-10", "C003", "499", "2024-04-01", "refunded", "Enterprise"),
]
CHURN_ROWS = [
    ("CUST-002", "2024-06-01", "Price"),
    ("CUST-002", "2024-07-01", "Price"),
    # Never billed.
    ("CUST-005", "2024-06-02", "Budget cuts"),
]


def extracts(spark):
    rows = {schemas.CRM: CRM_ROWS, schemas.BILLING: BILLING_ROWS, schemas.CHURN: CHURN_ROWS}
    return {
        name: spark.createDataFrame(rows[name], schema)
        for name, schema in schemas.EXTRACTS.items()
    }


def rows(df, *columns):
    """Rows as a sorted list of tuples; NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(row) for row in picked.collect()),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )
