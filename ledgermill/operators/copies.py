"""Repeated keys: keep the first copy, keep every copy, or count them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.operators.skew import HOT_ROWS, key_counts, semi_join_spread


def first_copy(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order`` (ascending, NULL first).

    ``order`` should name all other columns, so that only identical rows tie and the result does
    not depend on the partitioning. The filter on the row number lets Spark keep one row per key in
    every map task before the shuffle: a key with a third of all rows costs one row per task.
    """
    window = Window.partitionBy(key).orderBy(*(F.col(name).asc_nulls_first() for name in order))
    return df.withColumn("_copy", F.row_number().over(window)).where("_copy = 1").drop("_copy")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row, and their number of rows ``n``."""
    return key_counts(df, key).where(F.col("n") > 1)


def all_copies(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows of the keys with more than one row; a window count would put a key in one task."""
    return semi_join_spread(df, repeated_keys(df, key), key, hot_rows)
