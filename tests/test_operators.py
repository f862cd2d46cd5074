from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import copies, profiles, skew
from tests.tables import rows

#: One key with more than a third of the rows, others with a few, some NULL.
KEYED = (
    [("hot", i % 3, "same") for i in range(400)]
    + [(f"k{i % 90}", i, "x") for i in range(250)]
    + [(f"u{i}", i, "y") for i in range(150)]
    + [(None, i, "z") for i in range(40)]
)


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame(KEYED, "k string, n int, t string").repartition(6)


def test_first_copy_is_one_row_per_key(keyed):
    got = rows(copies.first_copy(keyed, "k", ["n", "t"]))
    first = {}
    for k, n, t in sorted(KEYED, key=lambda r: (r[0] or "", r[1], r[2])):
        first.setdefault(k, (k, n, t))
    assert sorted(got, key=str) == sorted(first.values(), key=str)
    again = copies.first_copy(copies.first_copy(keyed, "k", ["n", "t"]), "k", ["n", "t"])
    assert rows(again) == got


def test_first_copy_prunes_before_the_shuffle(keyed):
    plan = copies.first_copy(keyed, "k", ["n", "t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


@pytest.mark.parametrize("hot_rows", [1, 2, 7, 100, 10**6])
def test_all_copies(keyed, hot_rows):
    times = Counter(k for k, _, _ in KEYED)
    expected = Counter(r for r in KEYED if times[r[0]] > 1)
    assert Counter(tuple(r) for r in copies.all_copies(keyed, "k", hot_rows).collect()) == expected


@pytest.mark.parametrize("hot_rows", [1, 7, 100, 10**6])
def test_left_join_spread(spark, keyed, hot_rows):
    left = spark.createDataFrame(
        [("hot", "p"), ("hot", "q"), ("k1", "p"), ("u3", "p"), ("gone", "p"), (None, "p")],
        "k string, p string",
    )
    got = Counter(tuple(r) for r in skew.left_join_spread(left, keyed, "k", hot_rows).collect())
    expected = Counter()
    for k, p in [tuple(r) for r in left.collect()]:
        partners = [r for r in KEYED if k is not None and r[0] == k]
        for _, n, t in partners:
            expected[(k, p, n, t, True)] += 1
        if not partners:
            expected[(k, p, None, None, False)] += 1
    assert got == expected


def test_hot_key_is_dealt_out(spark, keyed):
    hot = skew.hot_keys(skew.key_counts(keyed, "k"), "k", 50)
    slices = skew._deal_out(keyed, hot, "k").where("k = 'hot'").groupBy("_slice").count().collect()
    assert len(slices) > 4
    assert max(r["count"] for r in slices) < 200


def test_value_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x")], "p string, q string")
    assert rows(profiles.value_counts(df, ["p", "q"])) == [
        ("p", None, 1), ("p", "a", 2), ("q", None, 1), ("q", "x", 2),
    ]


def test_profile_and_shape(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "p string, n int")
    assert rows(profiles.column_profile(df, "t")) == [
        ("t", 1, "p", "string", 1), ("t", 2, "n", "int", 2),
    ]
    assert rows(profiles.shape(df, "t")) == [("t", 2, 2)]


def test_preview_is_top_k(spark):
    df = spark.range(100).select((F.lit(99) - F.col("id")).alias("id"))
    top = profiles.preview(df, ["id"], 3)
    assert [r.id for r in top.collect()] == [0, 1, 2]
    assert "TakeOrdered" in top._jdf.queryExecution().executedPlan().toString()


def test_semi_join_dealt(spark, keyed):
    keys = spark.createDataFrame([("hot",), ("k1",), ("u3",), ("gone",), (None,)], "k string")
    got = Counter(tuple(r) for r in skew.semi_join_dealt(keyed, keys, "k", ("n", "t")).collect())
    assert got == Counter(r for r in KEYED if r[0] in ("hot", "k1", "u3"))
