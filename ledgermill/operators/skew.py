"""Joins that spread hot keys over many tasks.

AQE splits a skewed shuffle join only where both inputs come straight out of a shuffle and only on
the preserved side, which the joins here are not. So the rows of a hot key are dealt out over
slices, and the other side repeats its row of that key once per slice. Keys that are not hot have
one slice, so in clean data nothing is repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot above this many rows, and above one in MAX_HOT_KEYS of all rows. One slice then has
#: about as many. The second bound keeps the list of hot keys short whatever the size of the data.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000

#: Slices of every key where keys may be few; each slice of a key is one row of the other side.
FEW_KEYS_SLICES = 256

_SLICE = "_slice"
_SLICES = "_slices"
_HOT_KEY = "_hot_key"
_RIGHT_KEY = "_right_key"
_RIGHT_SLICE = "_right_slice"


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, NULL included. Combined on the map side: a hot key costs one row per task."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def hot_keys(
    counts: DataFrame, key: str, hot_rows: int = HOT_ROWS, max_keys: int = MAX_HOT_KEYS
) -> DataFrame:
    """Hot keys with their number of slices: fewer than ``max_keys``, since each has more than one
    in ``max_keys`` of the rows that ``counts`` counts."""
    share = F.ceil(F.coalesce(F.sum("n"), F.lit(0)) / max_keys).cast("bigint")
    limit = counts.agg(F.greatest(F.lit(hot_rows).cast("bigint"), share)).scalar()
    return counts.where(F.col("n") > limit).select(
        F.col(key).alias(_HOT_KEY), F.ceil(F.col("n") / limit).cast("int").alias(_SLICES)
    )


def _with_slices(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    # Safe to broadcast: `hot` has less than MAX_HOT_KEYS rows at any size.
    return df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(_HOT_KEY)), "left")


def _deal_out(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    # The hash separates different rows, the partition id separates exact copies; both are the
    # same again when a lost task is redone, which a random number need not be.
    place = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.col(_SLICES))
    return (
        _with_slices(df, hot, key)
        .withColumn(_SLICE, F.when(F.col(_SLICES).isNull(), 0).otherwise(place).cast("int"))
        .drop(_HOT_KEY, _SLICES)
    )


def _repeat(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    last = F.coalesce(F.col(_SLICES), F.lit(1)) - 1
    return _with_slices(df, hot, key).withColumn(_SLICE, F.explode(F.sequence(F.lit(0), last)))


def _matches(key: Column) -> Column:
    return key & (F.col(_SLICE) == F.col(_RIGHT_SLICE))


def semi_join_spread(
    df: DataFrame, counts: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows of ``df`` whose key (NULL included) is in ``counts``, a `key_counts` or a part of it."""
    hot = hot_keys(counts, key, hot_rows)
    wanted = _repeat(counts, hot, key).select(
        F.col(key).alias(_RIGHT_KEY), F.col(_SLICE).alias(_RIGHT_SLICE)
    )
    same_key = F.col(key).eqNullSafe(F.col(_RIGHT_KEY))
    return _deal_out(df, hot, key).join(wanted, _matches(same_key), "left_semi").drop(_SLICE)


def semi_join_dealt(df: DataFrame, keys: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``, a column of distinct keys; NULL is in none.

    For few keys with all the rows between them: a plain join has as many tasks as there are keys.
    Rows are dealt out by their values of ``by`` without a look at the keys, so the two sides do not
    wait for each other.
    """
    place = F.pmod(F.xxhash64(*by), F.lit(FEW_KEYS_SLICES)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(FEW_KEYS_SLICES - 1)))
    repeated = keys.select(key, every.alias(_SLICE))
    return df.withColumn(_SLICE, place).join(repeated, [key, _SLICE], "left_semi").drop(_SLICE)


def left_join_spread(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``left`` outer join ``right`` on equal keys, where ``right`` may have hot keys.

    ``left`` keeps its columns; of ``right`` all but the key are added, plus ``matched``. The other
    column names must differ between the two.
    """
    hot = hot_keys(key_counts(right.where(F.col(key).isNotNull()), key), key, hot_rows)
    dealt = (
        _deal_out(right, hot, key)
        .withColumnRenamed(key, _RIGHT_KEY)
        .withColumnRenamed(_SLICE, _RIGHT_SLICE)
    )
    joined = _repeat(left, hot, key).join(
        dealt, _matches(F.col(key) == F.col(_RIGHT_KEY)), "left"
    )
    matched = F.col(_RIGHT_KEY).isNotNull()
    # A hot key has a partner for sure, so an empty slice of it must not add an unmatched row.
    return (
        joined.where(matched | F.col(_SLICES).isNull())
        .withColumn("matched", matched)
        .drop(_HOT_KEY, _SLICES, _SLICE, _RIGHT_KEY, _RIGHT_SLICE)
    )
