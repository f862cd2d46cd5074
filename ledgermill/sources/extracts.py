"""CSV extracts of the CRM, the billing system and the churn list."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgermill import schemas

# Texts the dataframe readers of the raw mode take for missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: What becomes of a line with more or fewer fields than the header: it fails the job, or the row
#: stays, as far as it could be read, and is marked in the column MALFORMED.
FAIL, MARK = "fail", "mark"
MALFORMED = "malformed"
_LINE = "_corrupt_record"


def read_extract(spark: SparkSession, folder: str, name: str, malformed: str = FAIL) -> DataFrame:
    """One extract as text columns; empty text is NULL.

    The schema is given, so there is no inference pass, and headers are checked against it. ``name``
    may be a file or a folder of files.
    """
    fields = schemas.EXTRACTS[name.removesuffix(".csv")].fields
    reader = spark.read.schema(StructType([*fields, StructField(_LINE, StringType())]))
    reader = reader.option("header", True).option("enforceSchema", False)
    # A parser that skips columns does not see whether a line has all of them.
    reader = reader.option("columnPruning", False)
    lines = reader.option("columnNameOfCorruptRecord", _LINE).csv(os.path.join(folder, name))
    line = F.col(_LINE)
    if malformed == MARK:
        return lines.select(*(f.name for f in fields), line.isNotNull().alias(MALFORMED))
    first = F.coalesce(F.col(fields[0].name), F.lit(""))
    problem = F.concat(F.lit(f"malformed line in {name}, {fields[0].name} "), first, F.lit(": "), line)
    sound = F.when(line.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    return lines.where(sound).drop(_LINE)


def read_extracts(
    spark: SparkSession, folder: str, malformed: str = FAIL
) -> dict[str, DataFrame]:
    """The three extracts by table name."""
    return {
        name: read_extract(spark, folder, f"{name}.csv", malformed) for name in schemas.EXTRACTS
    }


def null_missing(df: DataFrame, texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Raw-mode reading: the usual texts for "missing" become NULL in every text column."""
    return df.select(
        *(
            F.when(~F.col(name).isin(*texts), F.col(name)).alias(name)
            if dtype == "string"
            else F.col(name)
            for name, dtype in df.dtypes
        )
    )
