"""CSV to report through written tables."""

import csv
import datetime
import os

import pytest

from ledgermill import schemas
from ledgermill.jobs import bronze, quality, report, silver
from ledgermill.plans import metrics, tables
from ledgermill.plans.filters import MetricFilter
from ledgermill.sources.extracts import null_missing, read_extract, read_extracts
from tests.tables import BILLING_ROWS, CHURN_ROWS, CRM_ROWS, rows


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    found = {name: str(base / name) for name in ("extracts", "bronze", "silver", "quality")}
    os.mkdir(found["extracts"])
    for (name, schema), data in zip(
        schemas.EXTRACTS.items(), (CRM_ROWS, BILLING_ROWS, CHURN_ROWS)
    ):
        with open(os.path.join(found["extracts"], f"{name}.csv"), "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(schema.names)
            writer.writerows([["" if v is None else v for v in row] for row in data])
    return found


@pytest.fixture(scope="module")
def written(spark, folders):
    return {
        **bronze.run(spark, folders["extracts"], folders["bronze"]),
        **silver.run(spark, folders["bronze"], folders["silver"]),
    }


def test_load_report(written):
    assert written == {
        "bronze_crm_customers": {"n_rows": 5, "null_signup_dates": 1},
        "bronze_billing_transactions": {"n_rows": 14},
        "bronze_churn": {"n_rows": 3},
        "silver_crm_customers": {"n_rows": 9, "billing_only": 3},
        "silver_billing_transactions": {"n_rows": 8},
        "silver_churn": {"n_rows": 3},
    }


def test_validation(spark, folders, written):
    found = bronze.validate(spark, folders["bronze"])
    assert found["bronze_crm_customers"] == {
        "total_rows": 5, "unique_customers": 5, "null_dates": 1, "null_stages": 1,
    }
    billing = found["bronze_billing_transactions"]
    assert int(billing.pop("gross_amount_incl_refunds")) == 3299
    assert billing == {"total_rows": 14, "unique_transactions": 10, "unique_customers": 6}


def test_round_trip(spark, folders, written):
    lazy = tables.bronze_tables(read_extracts(spark, folders["extracts"]))
    stored = bronze.read(spark, folders["bronze"])
    for name in schemas.BRONZE:
        assert rows(stored[name]) == rows(lazy[name])
    lazy = tables.silver_tables(stored)
    stored = silver.read(spark, folders["silver"])
    for name in schemas.SILVER:
        assert rows(stored[name].select(lazy[name].columns)) == rows(lazy[name])


def test_sql_on_registered_tables(spark, folders, written):
    silver.read(spark, folders["silver"])
    row = spark.sql(
        "SELECT count(*) AS n, count_if(month = 'NaT') AS undated FROM silver_billing_transactions"
    ).first()
    assert (row.n, row.undated) == (8, 1)


def test_date_bounds_skip_months(spark, folders, written):
    stored = silver.read(spark, folders["silver"])
    months = sorted(
        name for name in os.listdir(os.path.join(folders["silver"], "silver_billing_transactions"))
        if name.startswith("month=")
    )
    assert months == ["month=2024-01", "month=2024-02", "month=2024-03", "month=NaT"]
    f = MetricFilter(
        mode="clean",
        start_date=datetime.date(2024, 2, 1),
        end_date=datetime.date(2024, 2, 29),
        plans=("Enterprise",),
    )
    df = metrics.activity(tables.stored_relations(stored), f)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "month" in line)
    assert "2024-02" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(plan,Enterprise)" in scan and "transaction_date" in scan
    assert [r.customer_id for r in df.collect()] == ["CUST-002"]


def test_report_jobs(spark, folders, written):
    clean = report.run(spark, MetricFilter(mode="clean"), silver_dir=folders["silver"]).collect()
    figures = {r.label: r.value for r in clean if r.part == "kpi"}
    assert figures == {"total_revenue": 954.0, "active_customers": 4.0, "churn_rate": 20.0}
    raw = report.run(spark, MetricFilter(), extracts_dir=folders["extracts"]).collect()
    figures = {r.label: r.value for r in raw if r.part == "kpi"}
    assert figures == {"total_revenue": 3299.0, "active_customers": 6.0, "churn_rate": 0.0}
    with pytest.raises(ValueError):
        report.run(spark, MetricFilter(mode="clean"), extracts_dir=folders["extracts"])
    with pytest.raises(ValueError):
        report.run(spark, MetricFilter(mode="raw"), silver_dir=folders["silver"])


def test_quality_job(spark, folders):
    found = quality.run(spark, folders["extracts"], folders["quality"])
    assert found["dq_report"] == {"n_rows": 20}
    assert found["duplicate_transactions"] == {"n_rows": 8}
    stored = spark.read.parquet(os.path.join(folders["quality"], "billing_only_customers"))
    assert rows(stored) == [("CUST-009",), ("CUST-UST-001",)]


def test_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "churn_data.csv").write_text("customer_id,churn_reason,churn_date\na,b,c\n")
    with pytest.raises(Exception, match="header"):
        read_extract(spark, str(tmp_path), "churn_data.csv").collect()


def test_missing_texts(spark):
    df = spark.createDataFrame([("NA", 1), ("x", 2), (None, 3), ("null", 4)], "t string, n int")
    assert rows(null_missing(df), "n", "t") == [(1, None), (2, "x"), (3, None), (4, None)]
