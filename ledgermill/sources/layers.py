"""Parquet tables of the bronze and silver layers."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_table(
    df: DataFrame,
    folder: str,
    name: str,
    *,
    partition_by: str | None = None,
    **measures: Column,
) -> dict[str, object]:
    """Overwrite a table and return its row count and the given ``measures``, from the same pass.

    With ``partition_by`` the rows are rebalanced first: each partition value is written as files of
    about the advisory partition size, and AQE splits a value that holds many rows. The observation
    sits above that shuffle, in the writing stage, where each task is counted once even if it is
    redone after an executor was lost.
    """
    report = Observation(f"write {name}")
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    observed = df.observe(
        report,
        F.count("*").alias("n_rows"),
        *(measure.alias(alias) for alias, measure in measures.items()),
    )
    writer = observed.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(os.path.join(folder, name))
    return dict(report.get)


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """A table with a known schema: no footer is read for inference, and the type of a partition
    column is not guessed from its folder names."""
    return spark.read.schema(schema).parquet(os.path.join(folder, name))


def register(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
