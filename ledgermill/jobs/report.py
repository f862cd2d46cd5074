"""The report for one filter, from silver tables (clean mode) or from the extracts (raw mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.jobs import silver as silver_job
from ledgermill.plans import filters, metrics, tables
from ledgermill.plans.filters import MetricFilter
from ledgermill.sources.extracts import MARK, MALFORMED, null_missing, read_extracts
from ledgermill.sources.layers import write_table

REPORT, SHARES, TEXTS = "report", "stage_shares", "kpi_texts"


def relations(
    spark: SparkSession, f: MetricFilter, *, extracts_dir: str | None, silver_dir: str | None
) -> metrics.Relations:
    if f.mode == filters.RAW:
        if extracts_dir is None:
            raise ValueError("raw mode reads the extracts: give their folder")
        extracts = read_extracts(spark, extracts_dir, MARK)
        return tables.raw_relations(
            {name: null_missing(df.drop(MALFORMED)) for name, df in extracts.items()}
        )
    if silver_dir is None:
        raise ValueError("clean mode reads silver tables: give their folder")
    return tables.stored_relations(silver_job.read(spark, silver_dir))


def run(
    spark: SparkSession,
    f: MetricFilter,
    *,
    extracts_dir: str | None = None,
    silver_dir: str | None = None,
) -> DataFrame:
    """(part, label, value), sorted for reading."""
    source = relations(spark, f, extracts_dir=extracts_dir, silver_dir=silver_dir)
    return metrics.report(source, f).orderBy("part", "label")


def write(
    spark: SparkSession,
    f: MetricFilter,
    out_dir: str,
    *,
    extracts_dir: str | None = None,
    silver_dir: str | None = None,
) -> dict[str, dict[str, object]]:
    """Writes the whole report, and from it the shares of the stages and the texts of the key
    figures; returns rows written."""
    report = run(spark, f, extracts_dir=extracts_dir, silver_dir=silver_dir)
    written = {REPORT: write_table(report, out_dir, REPORT)}
    stored = spark.read.parquet(f"{out_dir}/{REPORT}")
    written[SHARES] = write_table(metrics.shares_of(stored), out_dir, SHARES)
    written[TEXTS] = write_table(metrics.texts_of(stored), out_dir, TEXTS)
    return written
