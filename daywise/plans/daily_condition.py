"""The daily condition table: use of both modes and the day's conditions, labelled."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    classify_day_type,
    classify_dust,
    classify_rain,
    classify_severe,
    fixed_values as fv,
    month_key,
)
from ..operators import daily_mean, daily_merge, daily_usage, join_modes, station_weather

DAILY_COLUMNS = (
    "use_date", "rain_day", "rain_class", "mode_a", "mode_b", "avg_pm", "dust_grade",
    "severe", "day_type", "ym",
)
DAILY_SCHEMA = (
    "use_date DATE, rain_day DOUBLE, rain_class STRING, mode_a BIGINT, mode_b BIGINT, "
    "avg_pm DOUBLE, dust_grade STRING, severe STRING, day_type STRING, ym STRING"
)


@dataclass(frozen=True)
class Rules:
    """Limits and labels for one city; the defaults are the fixed values."""

    heavy_from: float = fv.RAIN_HEAVY_FROM
    light_above: float = fv.RAIN_LIGHT_ABOVE
    dust_up_to: Sequence[float] = fv.DUST_UP_TO
    heat_from: float = fv.HEAT_FROM
    cold_to: float = fv.COLD_TO
    null_dust: str | None = fv.UNKNOWN
    labels: fv.LabelSet = field(default=fv.ENGLISH)


def merge_inputs(
    usage_a: DataFrame,
    usage_b: DataFrame,
    weather: DataFrame,
    dust: DataFrame | None = None,
    station: object = fv.CITY_STATION,
    dust_station: object = None,
) -> DataFrame:
    """Aggregate each input to the day in one scan of it, then join the daily frames."""
    modes = (
        daily_usage(usage_a, "mode_a").select("day", "mode_a"),
        daily_usage(usage_b, "mode_b").select("day", "mode_b"),
    )
    weather = station_weather(weather, station)
    if dust is None:
        no_mean = F.lit(None).cast("double").alias("avg_pm")
        return join_modes(*modes).join(weather, "day", "inner").select("*", no_mean)
    return daily_merge(*modes, weather, daily_mean(dust, "pm", "avg_pm", dust_station))


@dataclass(frozen=True)
class Roles:
    """Which rows of one shared log stand for which input."""

    usage_a: Column
    usage_b: Column
    rain: Column
    temperature: Column
    dust: Column


def merge_log(
    log: DataFrame, roles: Roles, rain: Column, tmax: Column, tmin: Column, tavg: Column
) -> DataFrame:
    """What `merge_inputs` gives when all four inputs are row sets of one log.

    One scan and one grouping with conditional aggregates replace five scans and four joins;
    the inner joins become the test that the day has rows of each needed role. `rain` to
    `tavg` are aggregate expressions over the rows of their role.
    """
    needed = {"a": roles.usage_a, "b": roles.usage_b, "rain": roles.rain, "t": roles.temperature}

    def usage(role: Column) -> Column:
        return F.sum(F.when(role, F.col("boardings"))) + F.sum(F.when(role, F.col("alightings")))

    merged = log.groupBy("day").agg(
        *[F.count(F.when(role, 1)).alias(f"_n_{name}") for name, role in needed.items()],
        usage(roles.usage_a).alias("mode_a"),
        usage(roles.usage_b).alias("mode_b"),
        F.coalesce(rain, F.lit(0.0)).alias("rain"),
        tmax.alias("tmax"),
        tmin.alias("tmin"),
        tavg.alias("tavg"),
        F.avg(F.when(roles.dust, F.col("pm"))).alias("avg_pm"),
    )
    for name in needed:
        merged = merged.filter(F.col(f"_n_{name}") > 0)
    return merged.drop(*[f"_n_{name}" for name in needed])


def label_days(merged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add all labels and the month key to the merged daily rows."""
    return merged.withColumns(
        {
            "rain_class": classify_rain(
                F.col("rain"), rules.heavy_from, rules.light_above, rules.labels
            ),
            "dust_grade": classify_dust(
                F.col("avg_pm"), rules.dust_up_to, rules.labels, rules.null_dust
            ),
            "severe": classify_severe(
                F.col("tmax"), F.col("tmin"), rules.heat_from, rules.cold_to, rules.labels
            ),
            "day_type": classify_day_type(F.col("day"), rules.labels),
            "ym": month_key(F.col("day")),
        }
    )


def daily_condition_table(merged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Label merged daily rows and keep the columns of the stored table."""
    labelled = label_days(merged, rules).withColumnsRenamed({"day": "use_date", "rain": "rain_day"})
    return labelled.select(*DAILY_COLUMNS)


def days_with_temperature(merged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(day, day_type, tavg, total): what the temperature report compares."""
    total = F.col("mode_a") + F.col("mode_b")
    labelled = label_days(merged, rules)
    return labelled.select("day", "day_type", "tavg", total.alias("total"))


def published_names(daily: DataFrame) -> DataFrame:
    """The six columns of the published CSV under their published names."""
    return daily.select(*[F.col(c).alias(name) for c, name in fv.PUBLISHED_NAMES.items()])


def table_names(daily: DataFrame) -> DataFrame:
    """The daily table under the column names of the published table."""
    return daily.withColumnsRenamed(fv.DAILY_TABLE_NAMES)
