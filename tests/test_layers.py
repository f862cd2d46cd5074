"""Bronze and silver plans, and the report on them, on tiny dirty extracts."""

import datetime
from decimal import Decimal

import pytest

from ledgermill.plans import bronze, metrics, quality, silver, tables
from ledgermill.plans.filters import MetricFilter
from ledgermill.schemas import BILLING, BRONZE, CHURN, CRM
from tests.tables import extracts, rows

DAY = datetime.date


@pytest.fixture(scope="module")
def raw(spark):
    return extracts(spark)


@pytest.fixture(scope="module")
def bronze_(raw):
    return tables.bronze_tables(raw)


@pytest.fixture(scope="module")
def silver_(bronze_):
    return tables.silver_tables(bronze_)


def test_bronze_types(bronze_):
    for name, schema in BRONZE.items():
        assert dict(bronze_[name].dtypes) == {f.name: f.dataType.simpleString() for f in schema}


def test_bad_amount_fails(spark, raw):
    bad = spark.createDataFrame(
        [("T", "C1", "4x9", "2024-01-01", "paid", "Growth")], raw[BILLING].schema
    )
    with pytest.raises(Exception, match="amount is not"):
        bronze.billing(bad).collect()


def test_transactions(silver_):
    got = rows(silver_[BILLING], "transaction_id", "customer_id", "amount", "transaction_date")
    assert got == [
        ("TX-1", "CUST-001", Decimal("149.00"), DAY(2024, 1, 10)),
        ("TX-2", "CUST-001", Decimal("49.00"), DAY(2024, 2, 10)),
        ("TX-3", "CUST-002", Decimal("499.00"), DAY(2024, 2, 11)),
        ("TX-5", "CUST-003", Decimal("49.00"), None),
        ("TX-6", "CUST-004", Decimal("149.00"), DAY(2024, 3, 14)),
        ("TX-7", "CUST-009", Decimal("149.00"), DAY(2024, 3, 15)),
        ("TX-8", "CUST-UST-001", Decimal("49.00"), DAY(2024, 3, 16)),
        ("TX-9", None, Decimal("10.00"), DAY(2024, 3, 17)),
    ]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_customers(bronze_, hot_rows):
    got = rows(
        silver.customers(bronze_[BILLING], bronze_[CRM], hot_rows),
        "customer_id", "plan", "industry", "pipeline_stage", "signup_date", "billing_only_flag",
    )
    assert got == [
        (None, "Starter", None, None, None, True),
        # Two billed plans are two rows, both with the CRM's plan.
        ("CUST-001", "Starter", "Retail", "Closed Won", DAY(2024, 11, 23), False),
        ("CUST-001", "Starter", "Retail", "Closed Won", DAY(2024, 11, 23), False),
        ("CUST-002", "Growth", "Finance", "Lead", DAY(2024, 2, 27), False),
        ("CUST-003", "Growth", "Retail", "Qualified", None, False),
        ("CUST-003", "Growth", "Retail", "Qualified", None, False),
        # No plan in the CRM: the billed one. An unknown spelling stays.
        ("CUST-004", "Growth", None, "closed lost", DAY(2024, 3, 2), False),
        ("CUST-009", "Growth", None, None, None, True),
        ("CUST-UST-001", "Starter", None, None, None, True),
    ]


def kpi(relations, **filter_):
    f = MetricFilter(**filter_)
    row = metrics.kpis(metrics.cohorts(metrics.activity(relations, f))).first()
    return (
        int(row.total_revenue), row.active_customers, row.unique_customers,
        row.churned_customers, row.churn_rate,
    )


@pytest.fixture(scope="module", params=["bronze", "silver"])
def clean(request, bronze_, silver_):
    if request.param == "bronze":
        return tables.clean_relations(bronze_)
    return tables.stored_relations(silver_)


def test_clean_kpis(clean):
    # CUST-004 has no industry, so it is out even if all industries are wanted; the transaction
    # without a customer is revenue, but no customer.
    assert kpi(clean, mode="clean") == (954, 4, 5, 1, 20.0)
    assert kpi(clean, mode="clean", status="active") == (455, 4, 4, 0, 0.0)
    assert kpi(clean, mode="clean", status="churned") == (499, 0, 1, 1, 100.0)
    assert kpi(clean, mode="clean", plans=("Growth",)) == (298, 2, 2, 0, 0.0)
    # Customers only billing knows pass any list of industries but the empty one.
    assert kpi(clean, mode="clean", industries=("Finance",)) == (707, 2, 3, 1, 33.3)
    assert kpi(clean, mode="clean", industries=()) == (0, 0, 0, 0, 0.0)
    assert kpi(clean, mode="clean", plans=()) == (0, 0, 0, 0, 0.0)
    # Both bounds belong to the range; a missing date is in no range.
    bounds = dict(start_date=DAY(2024, 2, 10), end_date=DAY(2024, 2, 11))
    assert kpi(clean, mode="clean", **bounds) == (548, 1, 2, 1, 50.0)


def test_clean_series(clean):
    f = MetricFilter(mode="clean")
    by_month = metrics.monthly_revenue(metrics.activity(clean, f, ("month",)))
    assert [(r.month, int(r.revenue)) for r in by_month.collect()] == [
        ("2024-01", 149), ("2024-02", 548), ("2024-03", 208), ("NaT", 49),
    ]
    by_plan = metrics.revenue_by_plan(metrics.activity(clean, f, ("plan",)))
    assert [(r.plan, int(r.revenue)) for r in by_plan.collect()] == [
        ("Enterprise", 499), ("Growth", 298), ("Starter", 157),
    ]
    new = metrics.new_customers(metrics.cohorts(metrics.activity(clean, f)))
    assert [tuple(r) for r in new.collect()] == [
        ("2024-01", 1), ("2024-02", 1), ("2024-03", 2), ("NaT", 1),
    ]


def test_start_date_makes_old_customers_new(clean):
    f = MetricFilter(mode="clean", start_date=DAY(2024, 2, 1))
    new = metrics.new_customers(metrics.cohorts(metrics.activity(clean, f)))
    assert [tuple(r) for r in new.collect()] == [("2024-02", 2), ("2024-03", 2)]


def test_clean_stages(clean):
    f = MetricFilter(mode="clean")
    got = metrics.stage_distribution(clean, f, metrics.activity(clean, f))
    # Two billed plans count twice; customers without a stage are not in the chart.
    assert [tuple(r) for r in got.collect()] == [
        ("Closed Won", 2, 0.4), ("Qualified", 2, 0.4), ("Lead", 1, 0.2),
    ]


def test_raw(raw):
    relations = tables.raw_relations(raw)
    assert kpi(relations, mode="raw") == (3299, 6, 6, 0, 0.0)
    # Ids of billing and churn differ in format, so nobody has churned, unless an id is in CRM
    # format by mistake (and not churned here).
    assert kpi(relations, mode="raw", status="active") == kpi(relations, mode="raw")
    assert kpi(relations, mode="raw", status="churned") == (0, 0, 0, 0, 0.0)
    assert kpi(relations, mode="raw", industries=()) == kpi(relations, mode="raw")
    f = MetricFilter(mode="raw", plans=())
    got = metrics.stage_distribution(relations, f, metrics.activity(relations, f))
    assert [(r.stage, r.customers) for r in got.collect()] == [
        ("Demo", 1), ("QUALIFIED", 1), ("closed lost", 1), ("closed_won", 1),
    ]


@pytest.mark.parametrize(
    "filter_",
    [
        dict(mode="clean"),
        dict(mode="clean", status="churned"),
        dict(mode="clean", plans=("Growth",), industries=("Retail",)),
        dict(mode="clean", plans=()),
        dict(mode="raw"),
        dict(mode="raw", status="churned"),
    ],
    ids=str,
)
def test_report_is_its_parts(raw, bronze_, filter_):
    f = MetricFilter(**filter_)
    relations = (
        tables.raw_relations(raw) if f.mode == "raw" else tables.clean_relations(bronze_)
    )
    parts = {}
    for row in metrics.report(relations, f).collect():
        parts.setdefault(row.part, {})[row.label] = row.value
    customers = metrics.activity(relations, f)
    cohorts = metrics.cohorts(customers)
    figures = metrics.kpis(cohorts).first()
    assert parts["kpi"] == {
        name: float(figures[name]) for name in ("total_revenue", "active_customers", "churn_rate")
    }
    series = {
        "monthly_revenue": metrics.monthly_revenue(metrics.activity(relations, f, ("month",))),
        "revenue_by_plan": metrics.revenue_by_plan(metrics.activity(relations, f, ("plan",))),
        "stage_distribution": metrics.stage_distribution(relations, f, customers),
        "new_customers": metrics.new_customers(cohorts),
    }
    for part, df in series.items():
        assert parts.get(part, {}) == {row[0]: float(row[1]) for row in df.collect()}


def test_revenue_adds_up(clean):
    f = MetricFilter(mode="clean")
    a = metrics.activity(clean, f, ("month", "plan"))
    total = metrics.kpis(metrics.cohorts(metrics.per_customer(a))).first().total_revenue
    for df in (metrics.monthly_revenue(a), metrics.revenue_by_plan(a)):
        assert sum(r.revenue for r in df.collect()) == total


def test_missing_id_matches_missing_id(spark, raw):
    """A churn list with an empty id marks the transactions without a customer."""
    churn = spark.createDataFrame([(None, None, None)], raw[CHURN].schema)
    relations = tables.raw_relations({**raw, CHURN: churn})
    assert kpi(relations, mode="raw", status="churned") == (10, 0, 0, 1, 0.0)


def test_filter_values_are_checked():
    with pytest.raises(ValueError):
        MetricFilter(mode="cleen")
    with pytest.raises(ValueError):
        MetricFilter(status="gone")


# Quality


def test_dq_report(raw):
    assert dict(rows(quality.dq_report(raw[CRM], raw[BILLING], raw[CHURN]))) == {
        "crm_rows": 5,
        "crm_null_stages": 1,
        "crm_nonstandard_stages": 3,
        "crm_nonstandard_dates": 2,
        "crm_unparsed_dates": 1,
        "crm_malformed_lines": 0,
        "crm_id_violations": 0,
        "billing_rows": 14,
        "billing_id_violations": 2,
        "billing_refund_rows": 3,
        "billing_duplicate_rows": 8,
        "billing_duplicated_ids": 4,
        "billing_bad_amounts": 0,
        "billing_unparsed_dates": 0,
        "billing_malformed_lines": 0,
        "billing_only_customers": 2,
        "churn_rows": 3,
        "churn_unparsed_dates": 0,
        "churn_id_violations": 0,
        "churn_malformed_lines": 0,
    }


def test_ladder_and_refunds(raw):
    billing = bronze.raw_billing(raw[BILLING])
    ladder = quality.revenue_ladder(billing)
    assert [int(v) for v in ladder.first()] == [3299, 1802, 1103]
    assert quality.revenue_ladder_labels(ladder).first()[0] == "$3,299.00"
    assert rows(quality.refund_summary(billing), "refund_rows", "refund_label") == [
        (3, "$1,497.00")
    ]
    assert rows(quality.duplicate_summary(billing)) == [(8, 4)]
    empty = billing.limit(0)
    assert [int(v) for v in quality.revenue_ladder(empty).first()] == [0, 0, 0]
    assert rows(quality.duplicate_summary(empty)) == [(0, 0)]
    assert rows(quality.refund_summary(empty)) == [(0, Decimal(0), "$0.00")]


def test_billing_only(raw, silver_):
    billing = bronze.raw_billing(raw[BILLING])
    assert rows(quality.billing_only_customers(billing, raw[CRM])) == [
        ("CUST-009",),
        ("CUST-UST-001",),
    ]
    flagged = rows(quality.flagged_customers(silver_[CRM]), "customer_id")
    assert flagged == [(None,), ("CUST-009",), ("CUST-UST-001",)]
