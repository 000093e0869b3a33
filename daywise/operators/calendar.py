"""Day and month spines, and which requested days were collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import is_weekend


def day_bounds(df: DataFrame, day: str = "day") -> DataFrame:
    """One row (lo, hi): first and last day."""
    return df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))


def calendar_spine(bounds: DataFrame, weekend_only: bool = False) -> DataFrame:
    """Every day between `lo` and `hi`, both included, as column `day`."""
    days = bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("day"))
    return days.filter(is_weekend(F.col("day"))) if weekend_only else days


def month_bounds(bounds: DataFrame) -> DataFrame:
    """First and last day of every month that `lo`..`hi` touches."""
    months = F.expr("sequence(trunc(lo, 'MM'), trunc(hi, 'MM'), interval 1 month)")
    return bounds.select(F.explode(months).alias("first_day")).select(
        F.date_format("first_day", "yyyyMM").alias("ym"),
        "first_day",
        F.last_day("first_day").alias("last_day"),
    )


def coverage_report(requested: DataFrame, collected: DataFrame, day: str = "day") -> DataFrame:
    """Rows found per requested day, and whether it was collected at all."""
    found = collected.groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"))
    n_rows = F.coalesce("n_rows", F.lit(0).cast("bigint"))
    return requested.join(found, day, "left").select(
        day,
        n_rows.alias("n_rows"),
        F.when(n_rows > 0, "collected").otherwise("missing").alias("status"),
    )


def missing_days(requested: DataFrame, collected: DataFrame, day: str = "day") -> DataFrame:
    return requested.join(collected.select(day), day, "left_anti")
