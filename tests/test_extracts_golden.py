"""Known figures of the original three extracts; LEDGERMILL_EXTRACTS names their folder."""

import datetime
import os

import pytest

from ledgermill.plans import bronze, metrics, quality, tables
from ledgermill.plans.filters import MetricFilter
from ledgermill.schemas import BILLING, CHURN, CRM
from ledgermill.sources.extracts import null_missing, read_extracts

FOLDER = os.environ.get("LEDGERMILL_EXTRACTS")
pytestmark = pytest.mark.skipif(not FOLDER, reason="LEDGERMILL_EXTRACTS is not set")

APRIL, JUNE, JULY = (
    datetime.date(2024, 4, 1),
    datetime.date(2024, 6, 30),
    datetime.date(2024, 7, 1),
)
#: Filter, then revenue, active, unique, churned, rate, rows.
KPIS = [
    (dict(mode="clean"), (146418, 87, 105, 18, 17.1, 582)),
    (dict(mode="clean", status="active"), (125067, 87, 87, 0, 0.0, 483)),
    (dict(mode="clean", status="churned"), (21351, 0, 18, 18, 100.0, 99)),
    (dict(mode="clean", plans=("Growth",)), (32184, 31, 39, 8, 20.5, 216)),
    (dict(mode="clean", industries=("Finance",)), (25932, 23, 25, 2, 8.0, 118)),
    (
        dict(
            mode="clean", industries=("Finance", "Retail"), start_date=APRIL, end_date=JUNE
        ),
        (13346, 23, 25, 2, 8.0, 54),
    ),
    (
        dict(mode="clean", plans=("Enterprise",), status="churned", start_date=JULY),
        (9980, 0, 5, 5, 100.0, 20),
    ),
    (dict(mode="clean", plans=()), (0, 0, 0, 0, 0.0, 0)),
    (dict(mode="raw"), (156879, 105, 105, 0, 0.0, 621)),
    (dict(mode="raw", status="churned"), (0, 0, 0, 0, 0.0, 0)),
    (dict(mode="raw", plans=("Growth",)), (34866, 39, 39, 0, 0.0, 234)),
    (dict(mode="raw", start_date=APRIL, end_date=JUNE), (36553, 58, 58, 0, 0.0, 147)),
]
MONTHS = [f"2024-{month:02d}" for month in range(1, 13)]
MONTHLY = {
    "clean": [1093, 5031, 7824, 9513, 12352, 13492, 15189, 17879, 17280, 21269, 22760, 2736],
    "raw": [1093, 5530, 7873, 10012, 13000, 13541, 15536, 19674, 19872, 22313, 25051, 3384],
}
NEW_CUSTOMERS = [7, 12, 7, 11, 11, 10, 8, 7, 2, 9, 11, 10]
BY_PLAN = {
    "clean": {"Enterprise": 106786, "Growth": 32184, "Starter": 7448},
    "raw": {"Enterprise": 114271, "Growth": 34866, "Starter": 7742},
}
STAGES = {
    "clean": {
        "Lead": 24, "Proposal": 18, "Closed Won": 17, "Closed Lost": 17, "Qualified": 11, "Demo": 8,
    },
    "raw": {
        "Closed Lost": 17, "Lead": 17, "Proposal": 15, "Demo": 8, "Qualified": 8, "Closed Won": 7,
        "Won": 6, "closed_won": 4, "QUALIFIED": 3, "proposal": 3,
    },
}


@pytest.fixture(scope="module")
def relations(spark):
    extracts = read_extracts(spark, FOLDER)
    raw = {name: null_missing(df) for name, df in extracts.items()}
    bronze_ = tables.bronze_tables(extracts)
    return {
        "raw": tables.raw_relations(raw),
        "clean": tables.clean_relations(bronze_),
        "stored": tables.stored_relations(tables.silver_tables(bronze_)),
    }


@pytest.mark.parametrize("filter_, expected", KPIS, ids=lambda v: str(v))
def test_kpis(relations, filter_, expected):
    f = MetricFilter(**filter_)
    for kind in ("raw",) if f.mode == "raw" else ("clean", "stored"):
        row = metrics.kpis(metrics.cohorts(metrics.activity(relations[kind], f))).first()
        assert (
            row.total_revenue, row.active_customers, row.unique_customers,
            row.churned_customers, row.churn_rate, row.n_transactions,
        ) == expected


@pytest.mark.parametrize("mode", ["clean", "raw"])
def test_report(relations, mode):
    parts = {}
    for row in metrics.report(relations[mode], MetricFilter(mode=mode)).collect():
        parts.setdefault(row.part, {})[row.label] = row.value
    assert parts["monthly_revenue"] == dict(zip(MONTHS, MONTHLY[mode]))
    assert parts["new_customers"] == dict(zip(MONTHS, NEW_CUSTOMERS))
    assert parts["revenue_by_plan"] == BY_PLAN[mode]
    assert parts["stage_distribution"] == STAGES[mode]


def test_quality(spark):
    extracts = {name: null_missing(df) for name, df in read_extracts(spark, FOLDER).items()}
    crm, billing, churn = extracts[CRM], bronze.raw_billing(extracts[BILLING]), extracts[CHURN]
    found = {r.check_name: r.n for r in quality.dq_report(crm, billing, churn).collect()}
    assert found == {
        "crm_rows": 95, "crm_null_stages": 7, "crm_nonstandard_stages": 16,
        "crm_nonstandard_dates": 10, "crm_id_violations": 0, "billing_rows": 621,
        "billing_id_violations": 0, "billing_refund_rows": 24, "billing_duplicate_rows": 30,
        "billing_duplicated_ids": 15, "billing_only_customers": 10, "churn_rows": 18,
        "churn_id_violations": 0,
    }
    assert [int(v) for v in quality.revenue_ladder(billing).first()] == [156879, 150803, 146418]
    assert quality.refund_summary(billing).first().refund_label == "$6,076.00"
    reasons = [tuple(r) for r in quality.churn_reason_counts(churn).collect()]
    assert reasons == [
        ("Budget cuts", 6), ("No longer needed", 4), ("Switched to competitor", 4),
        ("Poor support", 2), ("Price", 2),
    ]
