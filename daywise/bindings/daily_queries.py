"""Daily sums, joins, reshaping and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn, operators as op, plans
from ..functions import fixed_values as fv
from . import events as ev, trade as tr
from .registry import DAILY, LOG, TRADE, TRADE_DAYS, query

# Sums per day


@query(f"with {TRADE} select day, boardings, alightings, mode_a from da")
def daily_usage_a(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_usage(tr.usage_a(spark, sf), "mode_a")


@query(f"with {TRADE} select day, boardings, alightings, mode_b from db")
def daily_usage_b(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_usage(tr.usage_b(spark, sf), "mode_b")


@query(f"with {LOG} select day, cast(sum(reading) as double) / count(*) as avg_pm from u group by day")
def daily_avg_reading(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_mean(ev.log(spark, sf), "reading", "avg_pm")


# Joins

WEATHER = f"""{TRADE},
wx as (select day as tm, cast(sum(boardings) as double) / count(*) / 100 as rain
       from b where station = '1-URGENT' group by day)"""


@query(f"with {TRADE} select da.day, mode_a, mode_b from da join db on da.day = db.day")
def join_modes(spark: SparkSession, sf: str) -> DataFrame:
    mode_a = op.daily_usage(tr.usage_a(spark, sf), "mode_a").select("day", "mode_a")
    mode_b = op.daily_usage(tr.usage_b(spark, sf), "mode_b").select("day", "mode_b")
    return op.join_modes(mode_a, mode_b)


@query(f"with {WEATHER} select da.day, mode_a, wx.rain from da join wx on da.day = wx.tm")
def join_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Day columns of different names; weather of one station, checked to be unique per day."""
    mode_a = op.daily_usage(tr.usage_a(spark, sf), "mode_a").select("day", "mode_a")
    weather = op.station_weather(tr.weather(spark, sf), tr.STATION, day="tm")
    return op.join_conditions(mode_a, weather, "tm")


@query(f"""with {TRADE}, p as (
  select day as tm, cast(sum(boardings) as double) / count(*) as avg_pm from b group by day)
select da.day, mode_a, avg_pm from da left join p on da.day = p.tm""")
def join_left_dust(spark: SparkSession, sf: str) -> DataFrame:
    """Days without a reading stay, with a null mean."""
    mode_a = op.daily_usage(tr.usage_a(spark, sf), "mode_a").select("day", "mode_a")
    mean = op.daily_mean(tr.usage_b(spark, sf), "boardings", "avg_pm").withColumnRenamed("day", "tm")
    return op.join_conditions(mode_a, mean, "tm", "left")


@query(f"""with {WEATHER}, p as (
  select day, cast(sum(boardings) as double) / count(*) as avg_pm from a where flag = 'R' group by day)
select da.day, mode_a, mode_b, wx.rain, avg_pm
from da join db on da.day = db.day join wx on da.day = wx.tm left join p on da.day = p.day""")
def daily_merge(spark: SparkSession, sf: str) -> DataFrame:
    return plans.merge_inputs(
        tr.usage_a(spark, sf),
        tr.usage_b(spark, sf),
        tr.weather(spark, sf).withColumnRenamed("tm", "day"),
        tr.dust(spark, sf),
        tr.STATION,
    )


@query(f"""with {TRADE},
r as (select min(lo) as lo, max(hi) as hi from (
  select min(day) as lo, max(day) as hi from a union all select min(day), max(day) from b)),
s as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day from r),
f as (select day, count(*) as n_rows from b group by day)
select s.day, coalesce(n_rows, 0) as n_rows,
       case when n_rows > 0 then 'collected' else 'missing' end as status
from s left join f on s.day = f.day""")
def coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    """Days either table spans, and what `orders` has of them."""
    a, b = tr.usage_a(spark, sf).select("day"), tr.usage_b(spark, sf).select("day")
    requested = op.calendar_spine(op.day_bounds(op.union_by_name([a, b])))
    return op.coverage_report(requested, b)


@query(f"""with {TRADE}, r as (select min(day) as lo, max(day) as hi from b)
select day from (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day from r)
where isodow(day) >= 6""")
def calendar_spine(spark: SparkSession, sf: str) -> DataFrame:
    return op.calendar_spine(op.day_bounds(tr.usage_b(spark, sf)), weekend_only=True)


@query(f"""with {TRADE}, r as (select min(day) as lo, max(day) as hi from a)
select strftime(f, '%Y%m') as ym, f as first_day, last_day(f) as last_day
from (select cast(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi),
             interval 1 month)) as date) as f from r)""")
def month_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return op.month_bounds(op.day_bounds(tr.usage_a(spark, sf)))


# Groups

MEANS = {"mode_a": "avg_a", "mode_b": "avg_b"}


@query(f"""with {TRADE_DAYS}
select rain_class, round(avg(mode_a), 0) as avg_a, round(avg(mode_b), 0) as avg_b from x group by rain_class""")
def avg_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return op.avg_by_category(tr.days(spark, sf), "rain_class", MEANS)


LONG = f"""{TRADE_DAYS},
l as (select day, rain_class, day_type, 'a' as transport, mode_a as passengers from x
      union all select day, rain_class, day_type, 'b', mode_b from x)"""


def long_days(spark: SparkSession, sf: str) -> DataFrame:
    modes = {"mode_a": "a", "mode_b": "b"}
    return op.to_long(tr.days(spark, sf), ["day", "rain_class", "day_type"], modes, "transport", "passengers")


@query(f"""with {LONG}
select rain_class, transport, round(avg(passengers), 0) as passengers from l group by rain_class, transport""")
def avg_by_category_mode(spark: SparkSession, sf: str) -> DataFrame:
    return op.avg_by_category(
        long_days(spark, sf), ["rain_class", "transport"], {"passengers": "passengers"}
    )


@query(f"""with {TRADE_DAYS},
q as (select day_type, rain_class, count(mode_b) as n, quantile_cont(mode_b, 0.25) as q1,
             quantile_cont(mode_b, 0.5) as median, quantile_cont(mode_b, 0.75) as q3
      from x group by day_type, rain_class),
o as (select q.*, mode_b, mode_b between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
      from x join q on x.day_type = q.day_type and x.rain_class = q.rain_class)
select day_type, rain_class, n, q1, median, q3, min(case when inside then mode_b end) as whisker_lo,
       max(case when inside then mode_b end) as whisker_hi, count(case when not inside then 1 end) as n_outliers
from o group by day_type, rain_class, n, q1, median, q3""")
def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    return op.box_stats(tr.days(spark, sf), ["day_type", "rain_class"], "mode_b")


@query("""with q as (select l_returnflag as flag, l_linestatus as line, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) as q
  from lineitem group by l_returnflag, l_linestatus),
o as (select flag, line, q, l_extendedprice as price,
             l_extendedprice between q[1] - 1.5 * (q[3] - q[1]) and q[3] + 1.5 * (q[3] - q[1]) as inside
      from lineitem join q on l_returnflag = flag and l_linestatus = line)
select flag, line, count(*) as n, round(q[1], 4) as q1, round(q[2], 4) as median, round(q[3], 4) as q3,
       min(case when inside then price end) as whisker_lo,
       max(case when inside then price end) as whisker_hi, count(case when not inside then 1 end) as n_outliers
from o group by flag, line, q""")
def box_stats_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of all single readings of a few large groups."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line"), F.col("l_extendedprice").alias("price")
    )
    boxes = op.box_stats(rows, ["flag", "line"], "price")
    return boxes.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query(f"""with {LONG},
s as (select rain_class, transport, count(passengers) as n, avg(passengers) as m,
             stddev_samp(passengers) as sd from l group by rain_class, transport)
select rain_class, transport, n, round(m, 2) as mean, round(sd, 2) as sd,
       round(m - 1.96 * sd / sqrt(n), 2) as lo, round(m + 1.96 * sd / sqrt(n), 2) as hi from s""")
def mean_ci(spark: SparkSession, sf: str) -> DataFrame:
    return op.mean_ci(long_days(spark, sf), ["rain_class", "transport"], "passengers")


# Reshaping, union, order


@query(f"""with {TRADE_DAYS},
c as (select day_type, round(avg(mode_a), 0) as a, round(avg(mode_b), 0) as b from x group by day_type)
select day_type, 'a' as transport, a as passengers from c
union all select day_type, 'b', b from c""")
def unpivot_modes(spark: SparkSession, sf: str) -> DataFrame:
    means = op.avg_by_category(tr.days(spark, sf), "day_type", MEANS)
    return op.to_long(means, ["day_type"], {"avg_a": "a", "avg_b": "b"}, "transport", "passengers")


@query(f"with {LONG} select * from l")
def melt_daily(spark: SparkSession, sf: str) -> DataFrame:
    return long_days(spark, sf)


@query(f"""with {TRADE}
select day, boardings, alightings, mode_a, cast(null as bigint) as mode_b from da
union all select day, boardings, alightings, null, mode_b from db""")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return op.union_by_name(
        [
            op.daily_usage(tr.usage_a(spark, sf), "mode_a"),
            op.daily_usage(tr.usage_b(spark, sf), "mode_b"),
        ]
    )


@query(f"""with {DAILY}
select dust_grade, count(*) as n_days,
       case dust_grade when 'good' then 1 when 'normal' then 2 when 'bad' then 3 when 'very bad' then 4 end as ordinal
from d group by dust_grade order by ordinal""")
def ordered_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Days per dust grade in display order; `unknown` is not in the order and has no place."""
    counts = daily(spark, sf).groupBy("dust_grade").agg(F.count(F.lit(1)).alias("n_days"))
    ordinal = fn.category_ordinal(F.col("dust_grade"), fv.ENGLISH.dust)
    return counts.withColumn("ordinal", ordinal).orderBy(F.col("ordinal").asc_nulls_last())


# The daily table and its reports


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return plans.daily_condition_table(ev.merged_in_one_pass(spark, sf), ev.RULES)


@query(f"with {DAILY} select * from d")
def daily_condition_table(spark: SparkSession, sf: str) -> DataFrame:
    """All inputs lie in one table: one scan, one grouping."""
    return daily(spark, sf)


@query(f"with {DAILY} select * from d")
def daily_condition_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same table from four inputs that are aggregated each and joined."""
    return plans.daily_condition_table(ev.merged_by_joins(spark, sf), ev.RULES)


def _report(category: str, day_type: str, order: str = "") -> str:
    return f"""with {DAILY},
c as (select {category}, round(avg(mode_a), 0) as a, round(avg(mode_b), 0) as b from d
      where day_type = '{day_type}' group by {category}),
l as (select {category}, 'mode_a' as transport, a as passengers from c
      union all select {category}, 'mode_b', b from c)
select *{order} from l"""


RAIN_ORDER = ", case rain_class when 'heavy' then 1 when 'light' then 2 when 'none' then 3 end as ordinal"
DUST_ORDER = (
    ", case dust_grade when 'good' then 1 when 'normal' then 2 when 'bad' then 3"
    " when 'very bad' then 4 end as ordinal"
)


@query(_report("rain_class", "weekday", RAIN_ORDER))
def report_rain(spark: SparkSession, sf: str) -> DataFrame:
    return plans.report_rain(daily(spark, sf))


@query(_report("severe", "weekend"))
def report_severe(spark: SparkSession, sf: str) -> DataFrame:
    return plans.report_severe(daily(spark, sf))


@query(_report("dust_grade", "weekend", DUST_ORDER))
def report_dust(spark: SparkSession, sf: str) -> DataFrame:
    return plans.report_dust(daily(spark, sf))


@query(_report("rain_class", "weekday", RAIN_ORDER))
def report_year_rain(spark: SparkSession, sf: str) -> DataFrame:
    return plans.report_year_rain(daily(spark, sf))


@query(f"""with {TRADE_DAYS},
h as (select tavg, mode_a + mode_b as total, (select quantile_cont(tavg, 0.5) from x where day_type = 'weekend') as mid
      from x where day_type = 'weekend')
select case when tavg <= mid then 'low' else 'high' end as half, count(*) as n_days,
       round(avg(total), 2) as mean_total, round(stddev_samp(total), 2) as sd_total,
       max(total) - min(total) as range_total, round(stddev_samp(total) / avg(total), 6) as variation
from h group by 1""")
def report_temp_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    days = tr.days(spark, sf).withColumn("total", F.col("mode_a") + F.col("mode_b"))
    return plans.report_temp_sensitivity(days)


@query(f"""with {TRADE},
s as (select station, day, sum(boardings) as boardings, sum(boardings) + sum(alightings) as total,
             isodow(day) >= 6 as weekend from a group by station, day),
v as (select station,
        cast(sum(case when not weekend then total end) as double)
          / nullif(count(case when not weekend then 1 end), 0) as weekday_mean,
        cast(sum(case when weekend then total end) as double)
          / nullif(count(case when weekend then 1 end), 0) as weekend_mean,
        cast(sum(boardings) as double) / cast(sum(total) as double) as boarding_share
      from s group by station)
select station, weekday_mean, weekend_mean, weekday_mean / weekend_mean as weekday_ratio, boarding_share from v""")
def station_profile(spark: SparkSession, sf: str) -> DataFrame:
    return plans.station_profile(tr.usage_a(spark, sf))
