"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks.registry import queries
from ledgermill import schemas
from ledgermill.plans import metrics, tables
from ledgermill.plans.filters import MetricFilter
from ledgermill.schemas import BILLING
from ledgermill.session import MB, fit_partitions, partition_settings, stored_bytes
from ledgermill.sources import harness
from tests.tables import extracts

QUERIES = queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_bad_operators(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InMemoryTableScan"):
        assert bad not in plan


@pytest.mark.parametrize(
    "name", ["kpi_clean", "monthly_revenue_clean", "revenue_ladder", "duplicate_summary", "kpi_raw_plan"]
)
def test_billing_is_read_once(spark, sf_dir, name):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("l_orderkey#") > 0
    scans = [line for line in plan_of(QUERIES[name](spark, sf_dir)).splitlines()
             if "FileScan" in line and "lineitem" in line]
    assert len(scans) == 1


def test_filter_choices_take_one_pass_and_one_narrow_one(spark, sf_dir):
    plan = plan_of(QUERIES["filter_options"](spark, sf_dir))
    scans = [x for x in plan.splitlines() if "FileScan" in x and "lineitem" in x]
    assert len(scans) == 2 and plan.count("row_number(), 1, Final") == 1
    assert sum("l_shipdate" in x.split("ReadSchema")[1] for x in scans) == 1
    assert sum("FileScan" in x and "customer.parquet" in x for x in plan.splitlines()) == 1


def test_scans_are_pruned(spark, sf_dir):
    plan = plan_of(QUERIES["duplicate_summary"](spark, sf_dir))
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "lineitem" in x)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in scan


def test_dedup_prunes_before_its_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["silver_transactions"](spark, sf_dir))
    final, partial = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    exchange = plan.index("Exchange hashpartitioning(transaction_id")
    assert final < exchange < partial


def test_one_shuffle_by_customer_serves_the_key_figures(spark, sf_dir):
    """The grouping by customer is also the partitioning of the joins that follow."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["kpi_clean"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join [customer_id" in line]
    assert len(joins) == 2
    # Two for the joined id lists, one for the activity.
    exchanges = re.findall(
        r"Exchange hashpartitioning\((?:customer_id|_groupingexpression)#\d+, 8\)", plan
    )
    assert len(exchanges) == 3


def test_partition_sizes_follow_the_input(spark, sf_dir):
    small = partition_settings(10 * MB, 200)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * MB)
    medium = partition_settings(1024 * 1024 * MB, 200)
    assert medium["spark.sql.shuffle.partitions"] == "6144"
    large = partition_settings(100 * 1024 * 1024 * MB, 200)
    assert large["spark.sql.shuffle.partitions"] == "200000"
    assert int(large["spark.sql.files.maxPartitionBytes"]) > 1000 * MB
    assert stored_bytes(spark, sf_dir) > 1_000_000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    fit_partitions(spark, sf_dir)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_few_plans_are_looked_up_in_many_tasks(spark):
    """By plan alone all sums of a raw report would be in as many tasks as there are plans."""
    rows = [(f"TX-{i}", f"C{i:04}", "1", "2024-01-10", "paid", "Growth") for i in range(400)]
    billing = spark.createDataFrame(rows, schemas.EXTRACTS[BILLING])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        relations = tables.raw_relations(extracts(spark) | {BILLING: billing})
        summed = metrics._summed(relations, MetricFilter(mode="raw"), ("plan", "month"))
        held = summed.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in held) == 400
    assert len(held) > 4 and max(r["count"] for r in held) < 200


def test_few_partitions_do_not_hold_all_billing_rows(spark, tmp_path):
    """With a fixed number of partitions what one task sorts would grow with the input."""
    sf_dir, n = str(tmp_path), 1_500_000
    lines = spark.range(n).selectExpr(
        "id DIV 4 AS l_orderkey", "int(id % 4) AS l_linenumber", "rand(1) AS l_extendedprice",
        "'N' AS l_returnflag", "TIMESTAMP_NTZ '1997-05-01 00:00:00' AS l_shipdate",
    )
    lines.write.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.range(n // 4).selectExpr("id AS o_orderkey", "id % 1000 AS o_custkey")
    orders.write.parquet(f"{sf_dir}/orders.parquet")
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        billing = harness.billing(spark, sf_dir)
        held = billing.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in held) == n
    assert len(held) > 1 and max(r["count"] for r in held) < 0.7 * n
