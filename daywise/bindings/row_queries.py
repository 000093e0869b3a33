"""Projections, filters, null and type handling, labels: no shuffle in any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn, operators as op, plans
from . import events as ev, trade as tr
from .registry import LOG, TRADE, query


@query("select o_orderkey, o_custkey, o_orderpriority from orders")
def project_subset(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")


@query(f"with {LOG} select event_id, day, station, value from u where station = 8")
def filter_station(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev.log(spark, sf).select("event_id", "day", "station", "value")
    return op.filter_station(rows, ev.STATION)


@query(f"""with {LOG}
select event_id, day, value as rain from u where value >= 80 and isodow(day) < 6""")
def heavy_rain_weekdays(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev.log(spark, sf).withColumnRenamed("value", "rain")
    return plans.heavy_rain_days(rows, keep=["event_id", "day", "rain"])


@query(f"with {TRADE} select trip, day, boardings from b where isodow(day) >= 6")
def weekend_subset(spark: SparkSession, sf: str) -> DataFrame:
    rows = tr.usage_b(spark, sf).select("trip", "day", "boardings")
    return rows.filter(fn.is_weekend(F.col("day")))


@query(f"""with {LOG}
select event_id, case when event_type = 'error' then 0 else value end as rain from u""")
def fill_nulls(spark: SparkSession, sf: str) -> DataFrame:
    rain = F.when(~ev.kind("error"), F.col("value")).alias("rain")
    return fn.fill_nulls(ev.log(spark, sf).select("event_id", rain), {"rain": 0.0})


@query(f"""with {LOG}
select event_id, try_cast(case when event_type = 'error' then reading || 'x'
  else cast(reading as varchar) end as integer) as pm from u""")
def cast_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """Error rows carry a number with a letter behind it."""
    text = F.concat(F.col("reading").cast("string"), F.when(ev.kind("error"), "x").otherwise(""))
    return ev.log(spark, sf).select("event_id", fn.cast_lenient(text, "int").alias("pm"))


@query(f"with {LOG} select event_id, day from u")
def parse_day(spark: SparkSession, sf: str) -> DataFrame:
    number = F.date_format("day", "yyyyMMdd").cast("int")
    return ev.log(spark, sf).select("event_id", fn.parse_day(number).alias("day"))


@query(f"with {LOG} select event_id, case when event_type <> 'error' then day end as day from u")
def parse_day_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """Error rows carry `xx` for the month."""
    text = F.date_format("day", "yyyyMMdd")
    torn = F.when(ev.kind("error"), F.overlay(text, F.lit("xx"), 5, 2)).otherwise(text)
    return ev.log(spark, sf).select("event_id", fn.parse_day_lenient(torn).alias("day"))


@query(f"with {LOG} select event_id, day from u")
def day_from_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.col("stamp").cast("bigint")
    return ev.log(spark, sf).select("event_id", fn.day_from_stamp(stamp).alias("day"))


@query(f"""with {LOG}
select event_id, case when event_type not in ('error', 'signup') then value end as rain from u""")
def null_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    """Error rows carry -9, signups -99."""
    coded = F.when(ev.kind("error"), -9.0).when(ev.kind("signup"), -99.0).otherwise(F.col("value"))
    return ev.log(spark, sf).select("event_id", fn.null_sentinels(coded).alias("rain"))


@query(f"""with {LOG}
select event_id, value - 40 as rain,
  case when value - 40 >= 20 then 'heavy' when value - 40 > 0 then 'light' else 'none' end as rain_class
from u""")
def classify_rain(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev.log(spark, sf).select("event_id", (F.col("value") - 40).alias("rain"))
    return rows.withColumn("rain_class", fn.classify_rain(F.col("rain")))


@query(f"""with {LOG}
select event_id, case when value - 40 > 0 then 'wet' else 'dry' end as wet from u""")
def classify_wet(spark: SparkSession, sf: str) -> DataFrame:
    return ev.log(spark, sf).select("event_id", fn.classify_wet(F.col("value") - 40).alias("wet"))


@query(f"""with {LOG}
select event_id, case when event_type = 'view' then 'unknown' when value <= 30 then 'good'
  when value <= 80 then 'normal' when value <= 150 then 'bad' else 'very bad' end as dust_grade
from u""")
def classify_dust(spark: SparkSession, sf: str) -> DataFrame:
    """Views carry no reading."""
    pm = F.when(~ev.kind("view"), F.col("value"))
    return ev.log(spark, sf).select("event_id", fn.classify_dust(pm).alias("dust_grade"))


@query(f"""with {LOG}
select event_id, case when value - 40 >= 35 then 'heatwave' when value - 60 <= -15 then 'coldwave'
  else 'normal' end as severe from u""")
def classify_severe(spark: SparkSession, sf: str) -> DataFrame:
    tmax, tmin = F.col("value") - 40, F.col("value") - 60
    return ev.log(spark, sf).select("event_id", fn.classify_severe(tmax, tmin).alias("severe"))


@query(f"""with {TRADE}
select trip, day, case when isodow(day) >= 6 then 'weekend' else 'weekday' end as day_type from b""")
def classify_day_type(spark: SparkSession, sf: str) -> DataFrame:
    rows = tr.usage_b(spark, sf).select("trip", "day")
    return rows.withColumn("day_type", fn.classify_day_type(F.col("day")))


@query(f"with {TRADE} select trip, strftime(day, '%Y%m') as ym from b")
def month_key(spark: SparkSession, sf: str) -> DataFrame:
    return tr.usage_b(spark, sf).select("trip", fn.month_key(F.col("day")).alias("ym"))


@query(f"with {TRADE} select trip, day, boardings from b order by trip limit 5")
def head_rows(spark: SparkSession, sf: str) -> DataFrame:
    """First rows by key: each task keeps five, no sort of the whole."""
    return tr.usage_b(spark, sf).select("trip", "day", "boardings").orderBy("trip").limit(5)
