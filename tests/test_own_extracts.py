"""CSV files with one of every trap, and the figures they must give, from file to report."""

import datetime

import pytest

from ledgermill.jobs import bronze, quality, report, silver
from ledgermill.plans.filters import MetricFilter

# Two date formats and a third that is none; a missing stage and three spellings; a customer without
# plan or industry; one that was never billed.
CRM = """customer_id,company_name,industry,city,plan,pipeline_stage,signup_date,account_manager
CUST-101,Alder,Retail,Bern,Basic,closed_won,2023-05-06,AM-1
CUST-102,Birch,Finance,Bern,Plus,,06/05/2023,AM-1
CUST-103,Cedar,Retail,Basel,Plus,QUALIFIED,2023.05.07,AM-2
CUST-104,Dogwood,,Basel,,Demo,31/12/2023,AM-2
CUST-105,Elm,Retail,Chur,Basic,Won,2023-06-01,AM-2
"""
# Exact copies; copies that differ in status; a refund; a customer the CRM does not know; one customer
# on two plans; a "missing" text; a transaction without a plan.
BILLING = """transaction_id,customer_id,amount,transaction_date,status,plan
T-01,C101,100,2023-06-01,paid,Basic
T-01,C101,100,2023-06-01,paid,Basic
T-02,C101,250.50,2023-07-01,paid,Plus
T-03,C102,40,2023-07-02,paid,Plus
T-03,C102,40,2023-07-02,refunded,Plus
T-04,C102,40,2023-08-02,refunded,Plus
T-05,C103,60,2023-08-03,paid,Plus
T-06,C104,70,2023-08-04,paid,Basic
T-07,C900,80,2023-09-01,paid,Basic
T-08,C103,15,2023-09-02,paid,NA
T-09,C103,25,2023-09-03,refunded,Trial
"""
CHURN = """customer_id,churn_date,churn_reason
CUST-103,2023-10-01,Price
CUST-105,2023-10-02,Other
"""
JULY, AUGUST = datetime.date(2023, 7, 1), datetime.date(2023, 8, 31)
# Filter, then revenue, active customers and churn rate.
FIGURES = [
    (dict(mode="clean"), (545.5, 3, 25.0)),
    (dict(mode="clean", status="active"), (470.5, 3, 0.0)),
    (dict(mode="clean", status="churned"), (75.0, 0, 100.0)),
    (dict(mode="clean", plans=("Plus",)), (350.5, 2, 33.3)),
    (dict(mode="clean", industries=("Finance",)), (120.0, 2, 0.0)),
    (dict(mode="clean", start_date=JULY, end_date=AUGUST), (350.5, 2, 33.3)),
    (dict(mode="clean", plans=()), (0.0, 0, 0.0)),
    (dict(mode="raw"), (780.5, 5, 0.0)),
    (dict(mode="raw", plans=("Trial",)), (25.0, 1, 0.0)),
]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("own")
    found = {name: str(base / name) for name in ("extracts", "bronze", "silver", "out")}
    (base / "extracts").mkdir()
    for name, lines in (("crm_customers", CRM), ("billing_transactions", BILLING), ("churn_data", CHURN)):
        (base / "extracts" / f"{name}.csv").write_text(lines)
    bronze.run(spark, found["extracts"], found["bronze"])
    silver.run(spark, found["bronze"], found["silver"])
    return found


@pytest.mark.parametrize(("wanted", "figures"), FIGURES)
def test_key_figures(spark, folders, wanted, figures):
    f = MetricFilter(**wanted)
    rows = report.run(spark, f, extracts_dir=folders["extracts"], silver_dir=folders["silver"])
    found = {r.label: r.value for r in rows.where("part = 'kpi'").collect()}
    assert (found["total_revenue"], found["active_customers"], found["churn_rate"]) == figures


def test_series(spark, folders):
    rows = report.run(spark, MetricFilter(mode="clean"), silver_dir=folders["silver"]).collect()
    parts: dict = {}
    for r in rows:
        parts.setdefault(r.part, {})[r.label] = r.value
    assert parts["monthly_revenue"] == {"2023-06": 100.0, "2023-07": 290.5, "2023-08": 60.0, "2023-09": 95.0}
    assert parts["new_customers"] == {"2023-06": 1.0, "2023-07": 1.0, "2023-08": 1.0, "2023-09": 1.0}
    assert parts["stage_distribution"]["Closed Won"] == 2.0 and parts["stage_distribution"]["Lead"] == 1.0


def test_counters(spark, folders):
    quality.run(spark, folders["extracts"], folders["out"])
    read = lambda name: spark.read.parquet(f"{folders['out']}/{name}")
    counters = {r.check_name: r.n for r in read("dq_report").collect()}
    wanted = {
        "crm_null_stages": 1, "crm_nonstandard_stages": 3, "crm_nonstandard_dates": 3, "crm_unparsed_dates": 1,
        "billing_rows": 11, "billing_refund_rows": 3, "billing_duplicate_rows": 4, "billing_duplicated_ids": 2,
        "billing_only_customers": 1, "churn_rows": 2,
    }
    assert {k: counters[k] for k in wanted} == wanted
    assert [float(v) for v in read("revenue_ladder").first()] == [820.5, 715.5, 615.5]
