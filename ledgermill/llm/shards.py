"""Sharding by longest-processing-time scheduling: the largest groups first, each to the least loaded shard.

Documents of equal text form a group and stay together. Sizes are pre-aggregated by a 256-bit digest of the
text. Groups of one size are interchangeable for the schedule, so the driver gets (size, number of groups)
and schedules every group through a heap, runs of equal sizes at once. There are at most sqrt(2 * bytes)
distinct sizes, since distinct sizes add up to the bytes of all; in practice they are bounded by the longest
text. The groups of a size are numbered by digest, and the number tells the shard.

A group of at least total / (shards * GRAIN) bytes may have many rows; there are at most shards * GRAIN such
groups, whose shards are broadcast to the rows. The rows of all others are joined to their group by digest.

Within a size, and within a shard, rows are numbered in sub-buckets by hash and the sub-buckets' counts are
summed up, so no task holds a shard or all groups of a frequent size.

Defined results: null text counts as empty (size 8, crc32 0) and shares its group; rows with a null or a
repeated doc_id are placed like others; of groups with equal sizes those with smaller numbers go to the
shard with the smaller number; of shards with equal loads the first is taken; an empty table gives an empty
table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.shared import dropped, stored

SHARDS, GRAIN, OVERHEAD = 24, 1024, 8
#: Rows that one sub-bucket of a shard, or of a size, holds on average.
SLOT_ROWS = 50_000


def _dealt(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` equal sizes each shard gets if each goes to the least loaded one, first of ties."""
    shards = len(loads)
    if count <= 4 * shards or not size:
        heap, got = [(load, s) for s, load in enumerate(loads)], [0] * shards
        heapq.heapify(heap)
        for _ in range(count):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + size, s))
            got[s] += 1
        return got
    # A shard is taken at loads L, L + size, ...: the `count` least of all these, by (load, shard).
    below = lambda bound: [max(0, -(-(bound - load) // size)) for load in loads]  # noqa: E731  how many are under a bound
    low, high = min(loads), max(loads) + size * (count // shards + 2)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if sum(below(middle)) <= count else (low, middle)
    got = below(low)
    left = count - sum(got)
    for s, load in enumerate(loads):
        if left and load <= low and (low - load) % size == 0:
            got[s] += 1
            left -= 1
    return got


def schedule(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """(size, how many of its groups each shard gets) for (size, number of groups): largest first."""
    loads, out = [0] * shards, []
    for size, count in sorted(sizes, reverse=True):
        got = _dealt(loads, size, count)
        loads = [load + size * n for load, n in zip(loads, got, strict=True)]
        out.append((size, got))
    return out


def _numbered(rows: DataFrame, by: str, order: list[str], buckets: int, name: str) -> DataFrame:
    """`rows` with a column that numbers them from 0 within each value of `by`. They must be a stored table
    with a column `bucket` below `buckets`."""
    before = Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy(by, "bucket").count().select(by, "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy(by, "bucket").orderBy(*order)
    numbered = rows.withColumn("rank", F.row_number().over(within))
    if buckets == 1:
        return numbered.withColumn(name, F.col("rank").cast("bigint") - 1).drop("rank", "bucket")
    return numbered.join(stored(firsts), [by, "bucket"]).withColumn(name, F.col("first") + F.col("rank") - 1).drop("rank", "first", "bucket")


def _bucket(columns: list[str], buckets: int):
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).alias("bucket")


def _ranges(placed: list[tuple[int, list[int]]]) -> pa.Table:
    """(bytes, low, high, shard): the numbers, high excluded, that the groups of a size have in a shard."""
    size, low, high, shard = [], [], [], []
    for bytes_, got in placed:
        at = 0
        for s, n in enumerate(got):
            if n:
                size.append(bytes_)
                low.append(at)
                high.append(at + n)
                shard.append(s)
                at += n
    columns = {"bytes": pa.array(size, pa.int64()), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()), "shard": pa.array(shard, pa.int32())}
    return pa.table(columns)


def balanced(docs: DataFrame, shards: int = SHARDS, grain: int = GRAIN) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        docs["doc_id"].alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
    )
    rows = stored(rows)
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("groups"), F.sum("n").alias("n")).toArrow()
    size, count, n = (sizes[c].to_numpy() for c in ("bytes", "groups", "n"))
    total, n = sum(int(s) * int(c) for s, c in zip(size, count, strict=True)), int(n.sum())
    placement = spark.createDataFrame(_ranges(schedule(list(zip(size.tolist(), count.tolist(), strict=True)), shards)))
    parts = max(1, -(-int(np.max(count, initial=0)) // SLOT_ROWS))
    dealt = groups.select("key", "bytes", _bucket(["key"], parts))
    dealt = _numbered(stored(dealt) if parts > 1 else dealt, "bytes", ["key"], parts, "number")
    within = (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    placed = dealt.join(stored(placement), "bytes").where(within).select("key", "bytes", "shard")
    placed = stored(placed)
    is_large = F.col("bytes") * F.lit(shards * grain) >= F.lit(total)
    # At most shards * grain rows.
    large = F.broadcast(placed.where(is_large).select("key", F.col("shard").alias("large_shard")))
    rows = rows.join(large, "key", "left")
    small = rows.where("large_shard is null").drop("large_shard").join(placed.where(~is_large).select("key", "shard"), "key")
    rows = rows.where("large_shard is not null").withColumnRenamed("large_shard", "shard").unionByName(small)
    buckets = max(16, -(-n // (shards * SLOT_ROWS)))
    rows = stored(rows.select("doc_id", "size", "text_crc32", "shard", _bucket(["doc_id", "key"], buckets)))
    dropped(groups, placed)
    rows = _numbered(rows, "shard", ["doc_id", "text_crc32", "size"], buckets, "slot")
    return rows.select("doc_id", "size", "text_crc32", "shard", "slot")
