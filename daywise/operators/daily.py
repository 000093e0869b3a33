"""From raw readings to one row per day.

Each sum or mean is combined on the map side, so what is shuffled is one row per day and
task. A day that holds most of the input costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    cast_lenient,
    day_from_stamp,
    fill_nulls,
    null_sentinels,
    parse_day,
    parse_day_lenient,
)
from ..functions.fixed_values import MISSING_TEMPERATURE


def normalise_usage(df: DataFrame, columns: Mapping[str, object], lenient: bool = False) -> DataFrame:
    """Usage rows as (day DATE, boardings BIGINT, alightings BIGINT), with `station` if it is named.

    Each entry of `columns` is a name or lists candidate names; those the file has are coalesced in
    order. Malformed days and counts fail the job, or give null if `lenient`.
    """

    def first_of(name: str) -> Column:
        names = [columns[name]] if isinstance(columns[name], str) else columns[name]
        there = [F.col(f"`{n}`") for n in names if n in df.columns]
        if not there:
            raise ValueError(f"none of {names} is a column")
        return F.coalesce(*there)

    to_day = parse_day_lenient if lenient else parse_day
    counts = {name: first_of(name) for name in ("boardings", "alightings")}
    station = [F.col(f"`{columns['station']}`").alias("station")] if "station" in columns else []
    return df.select(
        to_day(first_of("day")).alias("day"),
        *station,
        *[
            (cast_lenient(raw, "bigint") if lenient else raw.cast("bigint")).alias(name)
            for name, raw in counts.items()
        ],
    )


def filter_station(df: DataFrame, station: object, column: str = "station") -> DataFrame:
    return df.filter(F.col(column) == F.lit(station))


def daily_usage(
    df: DataFrame, total: str, by: Sequence[str] = ("day",), also: Mapping[str, Column] | None = None
) -> DataFrame:
    """Sum boardings and alightings per day; `total` is their sum, null if either is null.

    A trip counts once where it starts and once where it ends, as published. `also` adds
    aggregates of the same rows to the same scan.
    """
    return (
        df.groupBy(*by)
        .agg(
            F.sum("boardings").alias("boardings"),
            F.sum("alightings").alias("alightings"),
            *[aggregate.alias(name) for name, aggregate in (also or {}).items()],
        )
        .withColumn(total, F.col("boardings") + F.col("alightings"))
    )


def daily_mean(
    df: DataFrame, value: str, out: str, station: object = None, day: str = "day"
) -> DataFrame:
    """Mean reading per day over all stations, or over one if `station` is given."""
    if station is not None:
        df = filter_station(df, station)
    return df.groupBy(day).agg(F.avg(value).alias(out))


def normalise_dust(df: DataFrame, keep: Mapping[str, str] | None = None) -> DataFrame:
    """Dust rows as (day, station, pm); text that is not a number gives a null reading.

    `keep` names further columns to pass on, with their new names.
    """
    return df.select(
        day_from_stamp(F.col("TM")).alias("day"),
        cast_lenient(F.col("STN_ID"), "int").alias("station"),
        cast_lenient(F.col("PM10"), "int").alias("pm"),
        *[F.col(raw).alias(name) for raw, name in (keep or {}).items()],
    )


def normalise_weather(df: DataFrame) -> DataFrame:
    """Weather rows as (day, station, rain, tavg, tmax, tmin).

    The code for a missing temperature becomes null, or the day would count as a cold wave. The one
    for rain stays, as published; `null_sentinels` takes it out.
    """
    temperatures = {"TA_AVG": "tavg", "TA_MAX": "tmax", "TA_MIN": "tmin"}
    return df.select(
        parse_day(F.col("TM")).alias("day"),
        F.col("STN").cast("int").alias("station"),
        cast_lenient(F.col("RN_DAY"), "double").alias("rain"),
        *[
            null_sentinels(cast_lenient(F.col(raw), "double"), [MISSING_TEMPERATURE]).alias(name)
            for raw, name in temperatures.items()
        ],
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, but a repeated key fails the job instead of multiplying later joins.

    The check is part of the plan: no extra job, and the grouping on the key is the
    partitioning a following join on it needs.
    """
    rest = [c for c in df.columns if c not in keys]
    failure = F.raise_error(F.concat(F.lit("repeated key: "), F.to_json(F.struct(*keys))))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
        .filter(F.when(F.col("_n") > 1, failure.cast("boolean")).otherwise(True))
        .select(*df.columns)
    )


def station_weather(df: DataFrame, station: object, day: str = "day") -> DataFrame:
    """One row per day for one station, missing rain taken as 0."""
    one = filter_station(df, station).drop("station")
    return require_unique(fill_nulls(one, {"rain": 0.0}), [day])
