"""Percentages with one decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_one_decimal(x: Column) -> Column:
    """Non-negative double to one decimal, half to even on its exact binary value.

    ``bround`` decides on the shortest decimal text of a double, so it takes 0.35 for a tie although
    the stored value is below it. Here x is compared with the midpoint (2k + 1) / 20 between two
    candidates, as the sign of 20 x - (2k + 1) = (16 x - (2k + 1)) + 4 x. Near the midpoint all of
    these steps are exact in double arithmetic, so ties are true ties.
    """
    k = F.floor(x * 10).cast("double")
    side = (x * 16 - (k * 2 + 1)) + x * 4
    up = (side > 0) | ((side == 0) & (k % 2 == 1))
    return (k + F.when(up, 1.0).otherwise(0.0)) / 10


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent, one decimal; 0 of nothing is 0."""
    return F.when(whole > 0, round_one_decimal(part / whole * 100.0)).otherwise(F.lit(0.0))
