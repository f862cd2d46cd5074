"""Column profiles and value counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, NULL included, as (column_name, value, n).

    Rows are first combined on all columns together, so only combinations are unpivoted.
    """
    combined = df.groupBy(*columns).agg(F.count("*").alias("n"))
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"))
            for name in columns
        )
    )
    return (
        combined.select(F.explode(pairs).alias("pair"), "n")
        .groupBy("pair.column_name", "pair.value")
        .agg(F.sum("n").alias("n"))
    )


def profile_entries(types: Sequence[tuple[str, str]], count: Callable[[str], Column]) -> Column:
    """An array of (position, column_name, data_type, non_null), one entry for each column."""
    return F.array(
        *(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(dtype).alias("data_type"),
                count(name).alias("non_null"),
            )
            for position, (name, dtype) in enumerate(types, start=1)
        )
    )


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Type and number of non-null values of every column, in one pass over the table."""
    counted = df.agg(*(F.count(F.col(name)).alias(name) for name in df.columns))
    return counted.select(F.lit(table).alias("table_name"), F.inline(profile_entries(df.dtypes, F.col)))


def shape(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(table).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def preview(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows, the same ones every time if ``order`` is total."""
    return df.orderBy(*order).limit(n)
