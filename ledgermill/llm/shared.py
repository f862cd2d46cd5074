"""The folder that all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
#: The temporary folder of this process, once one was needed.
_own: list[str] = []


def folder(spark: SparkSession) -> str:
    """A new path in the shared folder.

    The folder is what the cluster names in spark.checkpoint.dir. Only where that is unset, and only
    with a local master, a temporary folder stands for it; elsewhere it would not be shared.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="ledgermill-"))
        base = _own[0]
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Rows that go to a Python worker at once. Texts can be long, and both sides hold a whole batch.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch in this session to BATCH_ROWS; the results do not depend on it."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(setting))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of so many rows at most for what runs inside; for rows that are large themselves."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, rows)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


#: Lets a finished write give back the shuffle files that it needed; nothing reads them again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """For frames that are made and used up inside."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(frame: DataFrame, compression: str = "zstd") -> DataFrame:
    """The rows of a frame, written once to the shared folder and read from there."""
    spark = frame.sparkSession
    path = folder(spark)
    with shuffles_given_back(spark):
        frame.write.option("compression", compression).parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table._path = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove tables of `stored` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def often_enough(counts: DataFrame, column: str, limit: int) -> Column:
    """Whether a row's count is at least 2^k, for the smallest k that leaves `limit` rows at most."""
    level = F.floor(F.log2(column)).cast("int")
    sizes = {r["level"]: r["count"] for r in counts.where(F.col(column) >= 1).groupBy(level.alias("level")).count().collect()}  # 64 at most
    least, total = max(sizes, default=-1) + 1, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= limit:
        least -= 1
        total += sizes.get(least, 0)
    return F.col(column) >= F.lit(2**least)


def text_key(text: Column) -> Column:
    """256-bit digest that stands for a text; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(key, text, n): each text once, with the number of its documents; null is the empty text.

    Copies are summed up in each map task, so that a text with a third of all documents sends one row a task.
    """
    texts = docs.select(F.coalesce(docs["text"], F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("n"))
    return texts.select(text_key(F.col("text")).alias("key"), "text", "n")


def to_documents(docs: DataFrame, results: DataFrame) -> DataFrame:
    """Results of distinct texts (key, ...) for each document: doc_id and all but the key.

    A key with very many documents is split by the adaptive skew join, since both sides are plain shuffles.
    """
    rows = docs.select(docs["doc_id"].alias("doc_id"), text_key(docs["text"]).alias("key"))
    return rows.join(results, "key").drop("key")
