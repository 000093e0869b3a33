"""`events` standing for all four inputs.

Clicks are trips of mode A and views those of mode B, purchases are rain readings, signups
temperatures, errors dust readings. The first digit of `$.k` is the station.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import cast_lenient
from ..plans import Roles, Rules, label_days, merge_inputs, merge_log

STATION = 8
RULES = Rules(dust_up_to=(45.0, 50.0, 55.0), heat_from=300.0, cold_to=0.5)


def log(
    spark: SparkSession, sf: str, alighting: Column | None = None, placed: Column | None = None
) -> DataFrame:
    """The rows. Given conditions, alightings and stations are null, and unparsed, elsewhere."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    station = F.floor(k / 10).cast("int")
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id",
        F.col("ts").cast("date").alias("day"),
        F.date_format("ts", "yyyyMMddHHmm").alias("stamp"),
        "event_type",
        "user_id",
        "value",
        F.round(F.col("value") * 100).cast("bigint").alias("boardings"),
        (k if alighting is None else F.when(alighting, k)).alias("alightings"),
        (station if placed is None else F.when(placed, station)).alias("station"),
        F.round("value").cast("int").alias("reading"),
    )


def kind(name: str) -> Column:
    return F.col("event_type") == name


def mean_cents() -> Column:
    return F.try_divide(F.sum("boardings").cast("double"), F.count("boardings")) / 100


def dust_text() -> Column:
    """The dust sensor is serviced on Mondays and then sends no number."""
    return F.when(F.dayofweek("day") == 2, "-").otherwise(F.col("reading").cast("string"))


def weather(events: DataFrame) -> DataFrame:
    rain = events.filter(kind("purchase")).groupBy("day", "station").agg((mean_cents() - 40).alias("rain"))
    temperature = (
        events.filter(kind("signup"))
        .groupBy("day")
        .agg(F.max("value").alias("tmax"), F.min("value").alias("tmin"), mean_cents().alias("tavg"))
    )
    return rain.join(temperature, "day")


def dust(events: DataFrame) -> DataFrame:
    return events.filter(kind("error")).select(
        "day", "station", cast_lenient(dust_text(), "int").alias("pm")
    )


def merged_by_joins(spark: SparkSession, sf: str) -> DataFrame:
    events = log(spark, sf)
    return merge_inputs(
        events.filter(kind("click")),
        events.filter(kind("view")),
        weather(events),
        dust(events),
        STATION,
    )


def merged_in_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    # Parsing JSON is most of the work, and only trips and rain readings need it.
    events = log(spark, sf, alighting=kind("click") | kind("view"), placed=kind("purchase"))
    events = events.withColumn("pm", F.when(kind("error"), cast_lenient(dust_text(), "int")))
    roles = Roles(
        usage_a=kind("click"),
        usage_b=kind("view"),
        rain=kind("purchase") & (F.col("station") == STATION),
        temperature=kind("signup"),
        dust=kind("error"),
    )

    def mean_of(role: Column) -> Column:
        cents = F.when(role, F.col("boardings"))
        return F.try_divide(F.sum(cents).cast("double"), F.count(cents)) / 100

    warm = F.when(roles.temperature, F.col("value"))
    return merge_log(
        events, roles, mean_of(roles.rain) - 40, F.max(warm), F.min(warm), mean_of(roles.temperature)
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return label_days(merged_in_one_pass(spark, sf), RULES)
