"""`lineitem` and `orders` standing for the two modes, over some 2,400 days.

Mode A: quantities and line numbers per ship day and supplier (the station). Mode B: cents and
whole units of the order price per order day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import classify_day_type, classify_rain
from ..operators import daily_usage, join_modes

STATION = "1-URGENT"
HEAVY_FROM, LIGHT_ABOVE = 27.0, 24.0


def usage_a(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_suppkey").alias("station"),
        F.col("l_quantity").cast("bigint").alias("boardings"),
        F.col("l_linenumber").cast("bigint").alias("alightings"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("percent"),
        F.col("l_returnflag").alias("flag"),
    )


def usage_b(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("trip"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderpriority").alias("station"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("boardings"),
        F.floor("o_totalprice").cast("bigint").alias("alightings"),
        F.col("o_orderstatus").alias("status"),
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """One row per day and station, under a day name of its own."""
    return (
        usage_b(spark, sf)
        .groupBy(F.col("day").alias("tm"), "station")
        .agg((F.sum("boardings").cast("double") / F.count(F.lit(1)) / 100).alias("rain"))
    )


def dust(spark: SparkSession, sf: str) -> DataFrame:
    return usage_a(spark, sf).filter(F.col("flag") == "R").withColumnRenamed("boardings", "pm")


def days(spark: SparkSession, sf: str) -> DataFrame:
    """Days of both modes with rain (mean quantity), temperature (mean discount) and labels."""
    n = F.count(F.lit(1))
    mode_a = daily_usage(
        usage_a(spark, sf),
        "mode_a",
        also={
            "rain": F.sum("boardings").cast("double") / n,
            "tavg": F.sum("percent").cast("double") / n,
        },
    ).select("day", "mode_a", "rain", "tavg")
    mode_b = daily_usage(usage_b(spark, sf), "mode_b").select("day", "mode_b")
    return join_modes(mode_a, mode_b).withColumns(
        {
            "rain_class": classify_rain(F.col("rain"), HEAVY_FROM, LIGHT_ABOVE),
            "day_type": classify_day_type(F.col("day")),
        }
    )
