"""Session settings the jobs rely on, and partition sizes that follow from the input size."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

MB = 1024 * 1024

#: Needed for the results or for the plans to hold at scale; everything else stays with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size of the files that a table partitioned by month is written in.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Call sites of expressions only serve debugging; noting them takes longer than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The dedup prunes each map task to one row per id through this rule.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}

#: Columnar files grow about this much when their rows are shuffled.
EXPANSION = 3
#: Shuffled bytes per reduce task. Sorts spill, so this bounds time rather than memory.
SHUFFLE_BYTES = 512 * MB
#: More tasks than this on either side of a shuffle cost more in bookkeeping than they gain; past it
#: partitions grow instead (100 TB: 1 GB splits, 1.5 GB reduce partitions).
MAX_SPLITS = 100_000
MAX_SHUFFLE_PARTITIONS = 200_000
MIN_SPLIT_BYTES = 128 * MB


def build_session(app_name: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored_bytes(spark: SparkSession, *folders: str) -> int:
    """Size of folders on whatever file system they are."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for folder in folders:
        path = hadoop.fs.Path(folder)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


#: Shuffled bytes per reduce task of a query in a session whose partitions do not follow the input. AQE merges what
#: is smaller than its own target, so this only keeps the sorts of one task from growing with the input.
QUERY_SHUFFLE_BYTES = 16 * MB


def partition_settings(input_bytes: int, shuffle_partitions: int) -> dict[str, str]:
    """Settings for an input size. Never fewer shuffle partitions than the session has already;
    what turns out too small is merged by AQE, what is too large could not be split."""
    wanted = math.ceil(input_bytes * EXPANSION / SHUFFLE_BYTES)
    split = max(MIN_SPLIT_BYTES, math.ceil(input_bytes / MAX_SPLITS))
    return {
        "spark.sql.shuffle.partitions": str(
            max(shuffle_partitions, min(wanted, MAX_SHUFFLE_PARTITIONS))
        ),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def fit_partitions(spark: SparkSession, *folders: str) -> None:
    """Sizes the partitions of this session for a job that reads ``folders``."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in partition_settings(stored_bytes(spark, *folders), current).items():
        spark.conf.set(key, value)


def raise_partitions(spark: SparkSession, *folders: str) -> None:
    """More shuffle partitions for a query over ``folders``, if the session has few; never fewer."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(stored_bytes(spark, *folders) * EXPANSION / QUERY_SHUFFLE_BYTES)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(min(wanted, MAX_SHUFFLE_PARTITIONS)))
