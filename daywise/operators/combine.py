"""Joins of daily frames and union by name.

A daily frame has one row per calendar day, whatever the input size. No join is hinted:
adaptive execution sees the real size of each side and broadcasts one that is small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def join_modes(mode_a: DataFrame, mode_b: DataFrame, day: str = "day") -> DataFrame:
    """Days present in both modes."""
    return mode_a.join(mode_b, day, "inner")


def join_conditions(
    daily: DataFrame, other: DataFrame, other_day: str, how: str = "inner", day: str = "day"
) -> DataFrame:
    """Join on day columns of different names; only the left name is kept."""
    return daily.join(other.withColumnRenamed(other_day, day), day, how)


def daily_merge(
    mode_a: DataFrame, mode_b: DataFrame, weather: DataFrame, dust: DataFrame, day: str = "day"
) -> DataFrame:
    """Days that both modes and weather know; the dust mean is null where there is none."""
    return join_modes(mode_a, mode_b, day).join(weather, day, "inner").join(dust, day, "left")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
