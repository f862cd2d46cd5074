"""What no extract should hold: amounts the money type would round, texts, lines of the wrong length."""

import datetime
import os
from decimal import Decimal

import pytest

from ledgermill import __main__ as command
from ledgermill import schemas
from ledgermill.functions import money
from ledgermill.jobs import bronze, quality, report
from ledgermill.operators import skew
from ledgermill.plans import metrics, tables
from ledgermill.plans.filters import MetricFilter
from ledgermill.schemas import BILLING, CHURN, CRM
from ledgermill.sources.extracts import MALFORMED, MARK, read_extract, read_extracts
from ledgermill.sources.layers import write_table
from tests.tables import extracts, rows

CRM_LINES = """customer_id,company_name,industry,city,plan,pipeline_stage,signup_date,account_manager
CUST-001,One,Retail,Toronto,Growth,Won,2024-01-02,AM-1
CUST-002,Two,Finance,Ottawa,Starter,Lead,soon,AM-1
CUST-003,Three,Retail,Ottawa
"""
BILLING_LINES = """transaction_id,customer_id,amount,transaction_date,status,plan
TX-1,C001,10.50,2024-01-05,paid,Growth
TX-2,C001,49.995,2024-01-06,paid,Growth
TX-3,C002,n.a.,2024/02/01,paid,Starter
TX-4,C002,20,2024-02-02,refunded,Starter
TX-5,C009,30.00,2024-02-03,paid,Growth,more,fields
TX-6,C001,7
"""
CHURN_LINES = """customer_id,churn_date,churn_reason
CUST-002,2024-06-01,Price
CUST-003,June,Price
"""


@pytest.fixture(scope="module")
def dirty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dirty")
    for name, lines in ((CRM, CRM_LINES), (BILLING, BILLING_LINES), (CHURN, CHURN_LINES)):
        (folder / f"{name}.csv").write_text(lines)
    return str(folder)


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("10", "10.00"), (" 10.5 ", "10.50"), ("10.500", "10.50"), ("-3.1", "-3.10"), ("1e2", "100.00"),
        ("49.995", None), ("10.994", None), ("n.a.", None), ("12345678901.00", None), (None, None),
        ("1.0000000000000000001", None), ("", None),
    ],
)
def test_amounts_survive_or_are_missing(spark, text, value):
    df = spark.createDataFrame([(text,)], "amount string")
    got = df.select(money.coerced_money(df, "amount").alias("a"), money.is_bad_money(df, "amount").alias("bad")).first()
    assert got.a == (None if value is None else Decimal(value))
    assert got.bad == (text is not None and value is None)


def test_bronze_fails_on_what_it_cannot_hold(spark, tmp_path):
    for bad in ("49.995", "n.a."):
        df = spark.createDataFrame([(bad,)], "amount string")
        with pytest.raises(Exception, match="amount is not"):
            df.select(money.strict_money(df, "amount")).collect()


@pytest.mark.parametrize("line", ["CUST-1,2024-01-01", "CUST-1,2024-01-01,Price,more"])
def test_lines_of_the_wrong_length(spark, tmp_path, line):
    (tmp_path / f"{CHURN}.csv").write_text(f"customer_id,churn_date,churn_reason\nCUST-2,2024-01-01,x\n{line}\n")
    with pytest.raises(Exception, match="malformed line"):
        read_extract(spark, str(tmp_path), f"{CHURN}.csv").count()
    marked = read_extract(spark, str(tmp_path), f"{CHURN}.csv", MARK)
    assert rows(marked, "customer_id", MALFORMED) == [("CUST-1", True), ("CUST-2", False)]


def test_bronze_job_fails_on_dirt(spark, dirty, tmp_path):
    with pytest.raises(Exception):
        bronze.run(spark, dirty, str(tmp_path))


@pytest.fixture(scope="module")
def written(spark, dirty, tmp_path_factory):
    out, plans = str(tmp_path_factory.mktemp("out")), []

    def spy(df, folder, name, **more):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plans.append((name, plan.partition("== Initial Plan ==")[0]))
        return write_table(df, folder, name, **more)

    keep, quality.write_table = quality.write_table, spy
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)  # whole paths in plans
    try:
        return out, quality.run(spark, dirty, out), plans
    finally:
        quality.write_table = keep
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_quality_job_writes_every_table(spark, written):
    out, found, plans = written
    assert len(found) == 27 and sorted(os.listdir(out)) == sorted(found)
    counters = {r.check_name: r.n for r in spark.read.parquet(f"{out}/dq_report").collect()}
    wanted = {
        "crm_rows": 3, "crm_unparsed_dates": 1, "crm_malformed_lines": 1, "billing_rows": 6,
        "billing_bad_amounts": 2, "billing_unparsed_dates": 1, "billing_malformed_lines": 2,
        "billing_refund_rows": 1, "billing_only_customers": 1, "churn_rows": 2, "churn_unparsed_dates": 1,
        "churn_malformed_lines": 0,
    }
    assert {k: counters[k] for k in wanted} == wanted
    ladder = spark.read.parquet(f"{out}/revenue_ladder").first()
    assert [float(v) for v in ladder] == [67.5, 40.5, 40.5]


def test_billing_is_scanned_at_most_seven_times(written):
    scans = [name for name, plan in written[2] for line in plan.splitlines() if "FileScan csv" in line and f"{BILLING}.csv" in line]
    copies = [name for name in scans if name == "duplicate_transactions"]  # none where there are no copies
    assert len(copies) <= 2 and sorted(set(scans) - {"duplicate_transactions"}) == [
        "billed_ids", "billing_facts", "billing_firsts", "billing_value_counts", "filter_options",
    ]
    assert len(scans) - len(copies) == 5


def test_profile_is_of_the_extract_as_it_came(spark, written):
    profile = spark.read.parquet(f"{written[0]}/column_profile").where("table_name = 'billing'")
    got = {r.column_name: (r.data_type, r.non_null) for r in profile.collect()}
    assert got["transaction_date"] == ("string", 5) and got["amount"] == ("string", 6)


def test_previews_and_choices(spark, written):
    out = written[0]
    assert rows(spark.read.parquet(f"{out}/sample_refunds"), "transaction_id") == [("TX-4",)]
    assert spark.read.parquet(f"{out}/sample_billing").count() == 6
    assert rows(spark.read.parquet(f"{out}/filter_options")) == [
        ("date_max", "2024-02-03"), ("date_min", "2024-01-05"), ("industry", "Finance"),
        ("industry", "Retail"), ("plan", "Growth"), ("plan", "Starter"),
    ]


def test_list_of_hot_keys_is_bounded(spark):
    keyed = spark.range(1000).selectExpr("id % 40 AS k").unionByName(spark.createDataFrame([(7,)] * 900, "k bigint"))
    counts = skew.key_counts(keyed, "k")
    assert {r[0] for r in skew.hot_keys(counts, "k", 1, max_keys=5).collect()} == {7}
    hot = skew.hot_keys(counts, "k", 1, max_keys=100)
    assert hot.count() < 100
    limited = skew.semi_join_spread(keyed, counts, "k", 1)
    assert limited.count() == 1900


def test_default_plans_of_raw_mode(spark):
    found = extracts(spark)
    # A plan that only refunds have is not among the plans of cleaned data.
    more = [("TX-90", "C001", "5", "2024-01-01", "refunded", "Trial"), ("TX-91", "C001", "6", "2024-01-02", "paid", "Basic")]
    found[BILLING] = found[BILLING].unionByName(spark.createDataFrame(more, schemas.EXTRACTS[BILLING]))
    f = MetricFilter(mode="raw")
    plans = lambda relations: {r.plan for r in metrics.revenue_by_plan(metrics.activity(relations, f, ("plan",))).collect()}
    assert plans(tables.raw_relations(found)) == {"Growth", "Starter", "Enterprise", "Basic"}
    assert plans(tables.raw_relations(found, every_plan=True)) == {"Growth", "Starter", "Enterprise", "Basic", "Trial"}


@pytest.fixture(scope="module")
def clean(tmp_path_factory):
    folder = tmp_path_factory.mktemp("clean")
    lines = {CRM: CRM_LINES, BILLING: BILLING_LINES, CHURN: CHURN_LINES}
    for name, drop in ((CRM, ("CUST-003,Three",)), (BILLING, ("49.995", "n.a.", "more", "TX-6")), (CHURN, ("June",))):
        kept = [x for x in lines[name].splitlines() if not any(d in x for d in drop)]
        (folder / f"{name}.csv").write_text("\n".join(kept) + "\n")
    return folder


def test_command_line(spark, clean, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda name: spark)
    monkeypatch.setattr(command, "fit_partitions", lambda *folders: None)
    b, s, out = (str(tmp_path / x) for x in ("bronze", "silver", "report"))
    command.main(["bronze", "--extracts", str(clean), "--bronze", b])
    command.main(["silver", "--bronze", b, "--silver", s])
    command.main(["report", "--silver", s, "--mode", "clean", "--out", out])
    printed = capsys.readouterr().out
    assert f"rows; all are in {out}/report" in printed
    texts = dict(rows(spark.read.parquet(f"{out}/kpi_texts")))
    assert texts == {"total_revenue": "$10", "active_customers": "1", "churn_rate": "0.0%"}
    assert rows(spark.read.parquet(f"{out}/stage_shares")) == [("Closed Won", 1, 1.0)]
    command.main(["report", "--silver", s, "--mode", "clean", "--no-plan", "--out", out])
    assert dict(rows(spark.read.parquet(f"{out}/kpi_texts")))["active_customers"] == "0"
    command.main(["report", "--extracts", str(clean), "--start", "2024-02-01", "--plan", "Starter", "--out", out])
    assert "$20" in dict(rows(spark.read.parquet(f"{out}/kpi_texts"))).values()
    command.main(["quality", "--extracts", str(clean), "--out", str(tmp_path / "quality")])
    with pytest.raises(SystemExit):
        command.main(["report", "--out", out, "--no-plan", "--plan", "Growth"])


def test_report_has_every_row(spark, tmp_path):
    stages = [(f"CUST-{i}", "c", "r", "t", "p", f"stage {i}", "2024-01-01", "a") for i in range(300)]
    for name, data in ((CRM, stages), (BILLING, []), (CHURN, [])):
        frame = spark.createDataFrame(data, schemas.EXTRACTS[name])
        frame.coalesce(1).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    written = report.write(spark, MetricFilter(start_date=datetime.date(2024, 1, 1)), str(tmp_path / "out"), extracts_dir=str(tmp_path))
    assert written["stage_shares"]["n_rows"] == 300 and written["report"]["n_rows"] == 303


def test_extracts_stay_columns(spark, dirty):
    for name, df in read_extracts(spark, dirty, MARK).items():
        assert df.columns == [*schemas.EXTRACTS[name].names, MALFORMED]
