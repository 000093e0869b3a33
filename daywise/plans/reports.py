"""Reports on the daily table. Each returns a small frame; drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import category_ordinal, classify_day_type, fixed_values as fv
from ..operators import avg_by_category, daily_usage, moment_mean, moment_sd, moment_sums, to_long

MODES = {"avg_a": "mode_a", "avg_b": "mode_b"}


def mean_use_by(
    daily: DataFrame,
    category: str,
    day_type: str,
    order: Sequence[str] | None = None,
    modes: Mapping[str, str] = MODES,
) -> DataFrame:
    """Mean use of both modes per category on one day type, long, with the display order."""
    means = {name: mean for mean, name in modes.items()}
    per_category = avg_by_category(
        daily.filter(F.col("day_type") == day_type), category, means
    )
    long = to_long(per_category, [category], modes, "transport", "passengers")
    if order is None:
        return long
    return long.withColumn("ordinal", category_ordinal(F.col(category), order))


def report_rain(daily: DataFrame, labels: fv.LabelSet = fv.ENGLISH) -> DataFrame:
    """Does rain change weekday use?"""
    return mean_use_by(daily, "rain_class", labels.day_type[0], labels.rain)


def report_severe(daily: DataFrame, labels: fv.LabelSet = fv.ENGLISH) -> DataFrame:
    """Does severe weather change weekend use?"""
    return mean_use_by(daily, "severe", labels.day_type[1])


def report_dust(daily: DataFrame, labels: fv.LabelSet = fv.ENGLISH) -> DataFrame:
    """Does dust change weekend use?"""
    return mean_use_by(daily, "dust_grade", labels.day_type[1], labels.dust)


def report_year_rain(daily: DataFrame, labels: fv.LabelSet = fv.ENGLISH) -> DataFrame:
    """Weekdays melted to one row per day and mode, then the mean by rain class and mode."""
    weekdays = daily.filter(F.col("day_type") == labels.day_type[0])
    long = to_long(
        weekdays,
        ["use_date", "rain_class"],
        {"mode_a": "mode_a", "mode_b": "mode_b"},
        "transport",
        "passengers",
    )
    means = avg_by_category(long, ["rain_class", "transport"], {"passengers": "passengers"})
    return means.withColumn("ordinal", category_ordinal(F.col("rain_class"), labels.rain))


def heavy_rain_days(
    weather: DataFrame,
    at_least: float = fv.RAIN_DOWNPOUR_FROM,
    labels: fv.LabelSet = fv.ENGLISH,
    keep: Sequence[str] = ("day", "rain"),
) -> DataFrame:
    """Weekdays with a downpour."""
    weekday = classify_day_type(F.col("day"), labels) == labels.day_type[0]
    return weather.filter((F.col("rain") >= at_least) & weekday).select(*keep)


def report_temp_sensitivity(
    days: DataFrame, day_type: str = fv.ENGLISH.day_type[1], decimals: int = 2
) -> DataFrame:
    """Is the spread of total use wider on cold or on warm days?

    Days (day, day_type, tavg, total) of one type that have both values are split at their exact median temperature.
    The median is a scalar subquery on the same daily sums, which adaptive execution makes once: its
    partial counts meet in one task, the days do not.
    """
    known = F.col("tavg").isNotNull() & F.col("total").isNotNull()
    chosen = days.filter((F.col("day_type") == day_type) & known)
    median = chosen.select(F.percentile("tavg", 0.5)).scalar()
    return (
        chosen.withColumn("half", F.when(F.col("tavg") <= median, "low").otherwise("high"))
        .groupBy("half")
        .agg(*moment_sums("total"), (F.max("total") - F.min("total")).alias("range_total"))
        .withColumns({"_mean": moment_mean(), "_sd": moment_sd()})
        .select(
            "half",
            F.col("_n").alias("n_days"),
            F.round("_mean", decimals).alias("mean_total"),
            F.round("_sd", decimals).alias("sd_total"),
            "range_total",
            F.round(F.try_divide("_sd", "_mean"), 6).alias("variation"),
        )
    )


def station_profile(usage: DataFrame, labels: fv.LabelSet = fv.ENGLISH) -> DataFrame:
    """How an area is used: weekday and weekend mean per day, their ratio, boarding share."""
    weekday, weekend = labels.day_type
    by_day = daily_usage(usage, "total", by=("station", "day")).withColumn(
        "day_type", classify_day_type(F.col("day"), labels)
    )

    def mean_total(kind: str):
        return F.avg(F.when(F.col("day_type") == kind, F.col("total")))

    return (
        by_day.groupBy("station")
        .agg(
            mean_total(weekday).alias("weekday_mean"),
            mean_total(weekend).alias("weekend_mean"),
            F.sum("boardings").alias("_boardings"),
            F.sum("total").alias("_total"),
        )
        .select(
            "station",
            "weekday_mean",
            "weekend_mean",
            F.try_divide("weekday_mean", "weekend_mean").alias("weekday_ratio"),
            F.try_divide(F.col("_boardings").cast("double"), F.col("_total").cast("double")).alias(
                "boarding_share"
            ),
        )
    )
