import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.functions import dates, ids, labels, rates, stages


def values(spark, texts, expression, kind="string"):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], f"i int, x {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_ids(spark):
    texts = ["C001", "CUST-001", "X9", "C0C1", None]
    assert values(spark, texts, ids.to_crm_id) == [
        "CUST-001", "CUST-UST-001", "X9", "CUST-0C1", None,
    ]
    assert values(spark, texts[:1] + texts[3:], ids.to_crm_id_everywhere) == [
        "CUST-001", "CUST-0CUST-1", None,
    ]


def test_id_violations(spark):
    texts = ["CUST-001", "CUST-1", "CUST-", "cust-001", "C001", " CUST-001", None]
    bad = values(spark, texts, lambda c: ids.violates(c, ids.CRM_ID))
    assert bad == [False, False, True, True, True, True, True]
    assert values(spark, ["C001", "CUST-001"], lambda c: ids.violates(c, ids.BILLING_ID)) == [
        False,
        True,
    ]


def test_signup_dates(spark):
    texts = ["2024-03-15", "15/03/2024", "03/04/2024", "2024.03.15", "31/31/2024", "", None]
    day = datetime.date
    assert values(spark, texts, dates.signup_date) == [
        day(2024, 3, 15), day(2024, 3, 15), day(2024, 4, 3), None, None, None, None,
    ]


def test_strict_and_coerced_dates(spark):
    good = spark.createDataFrame([("2024-03-15",), (None,)], "d string")
    assert good.select(dates.strict_date(good, "d")).count() == 2
    bad = spark.createDataFrame([("15/03/2024",)], "d string")
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed"):
        bad.select(dates.strict_date(bad, "d")).collect()
    assert bad.select(dates.coerced_date(bad, "d")).first()[0] is None
    typed = spark.createDataFrame([(datetime.date(2024, 1, 2),)], "d date")
    for parse in (dates.strict_date, dates.coerced_date):
        assert typed.select(parse(typed, "d")).first()[0] == datetime.date(2024, 1, 2)


def test_month_label(spark):
    days = [datetime.date(2024, 3, 31), None]
    assert values(spark, days, dates.month_label, "date") == ["2024-03", "NaT"]


def test_stages(spark):
    texts = [
        "closed_won", "Won", "CLOSED_LOST", "QUALIFIED", "proposal", "demo", "lead",
        "Closed Won", "Closed Lost", "closed lost", "Other", None,
    ]
    assert values(spark, texts, stages.standard_stage) == [
        "Closed Won", "Closed Won", "Closed Lost", "Qualified", "Proposal", "Demo", "Lead",
        "Closed Won", "Closed Lost", "closed lost", "Other", "Lead",
    ]
    odd = values(spark, texts, stages.is_nonstandard)
    assert odd == [True] * 7 + [False, False, True, True, False]


def test_percentage_examples(spark):
    pairs = [(1, 16), (18, 105), (0, 0), (0, 5), (5, 5), (7, 2000), (3, 16), (1, 3)]
    df = spark.createDataFrame(pairs, "c bigint, n bigint")
    got = [r[0] for r in df.select(rates.percentage(F.col("c"), F.col("n"))).collect()]
    assert got == [6.2, 17.1, 0.0, 0.0, 100.0, round(7 / 2000 * 100, 1), 18.8, 33.3]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=50, max_size=400))
def test_percentage_rounds_like_python(spark, pairs):
    pairs = [(min(c, n), n) for c, n in pairs]
    df = spark.createDataFrame(pairs, "c bigint, n bigint")
    got = [r[0] for r in df.select(rates.percentage(F.col("c"), F.col("n"))).collect()]
    assert got == [round(c / n * 100, 1) for c, n in pairs]


def test_percentage_rounds_like_python_on_all_small_shares(spark):
    df = spark.range(1, 401).withColumnRenamed("id", "n")
    df = df.select("n", F.explode(F.sequence(F.lit(0).cast("bigint"), "n")).alias("c"))
    rows = df.select("c", "n", rates.percentage(F.col("c"), F.col("n")).alias("rate")).collect()
    assert all(r.rate == round(r.c / r.n * 100, 1) for r in rows)


def test_ties_in_binary(spark):
    # Multiples of 0.05 that a double does and does not hold exactly.
    xs = [i / 20 for i in range(0, 2001)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(rates.round_one_decimal(F.col("x"))).collect()]
    assert got == [round(x, 1) for x in xs]


def test_labels(spark):
    df = spark.createDataFrame([(1234567, 17.1)], "n bigint, r double")
    row = df.select(
        labels.money(F.col("n")), labels.money(F.col("n"), 2), labels.count(F.col("n")),
        labels.percent(F.col("r")), labels.percent(F.lit(0.0)), labels.percent(F.lit(100.0)),
        labels.money(F.lit("2.50").cast("decimal(12,2)")),
    ).first()
    assert tuple(row) == (
        "$1,234,567", "$1,234,567.00", "1,234,567", "17.1%", "0.0%", "100.0%", "$2",
    )
