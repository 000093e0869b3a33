"""The query registry: a function of (spark, folder) and, with it, the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


# `events` rows as bindings.events.log has them.
LOG = """u as (
  select event_id, cast(ts as date) as day, strftime(ts, '%Y%m%d%H%M') as stamp, event_type,
         user_id, value, cast(round(value * 100) as bigint) as boardings,
         cast(json_extract(props, '$.k') as bigint) as alightings,
         cast(cast(json_extract(props, '$.k') as bigint) // 10 as integer) as station,
         cast(round(value) as integer) as reading
  from events)"""

# The four inputs per day, joined.
MERGED = f"""{LOG},
ma as (select day, cast(sum(boardings) + sum(alightings) as bigint) as mode_a
       from u where event_type = 'click' group by day),
mb as (select day, cast(sum(boardings) + sum(alightings) as bigint) as mode_b
       from u where event_type = 'view' group by day),
w as (select day, cast(sum(boardings) as double) / count(*) / 100 - 40 as rain
      from u where event_type = 'purchase' and station = 8 group by day),
t as (select day, max(value) as tmax, min(value) as tmin,
             cast(sum(boardings) as double) / count(*) / 100 as tavg
      from u where event_type = 'signup' group by day),
p as (select day, cast(sum(pm) as double) / nullif(count(pm), 0) as avg_pm
      from (select day, case when dayofweek(day) = 1 then null else reading end as pm
            from u where event_type = 'error') group by day),
m as (select ma.day, mode_a, mode_b, rain, tmax, tmin, tavg, avg_pm
      from ma join mb on ma.day = mb.day join w on ma.day = w.day join t on ma.day = t.day
           left join p on ma.day = p.day)"""


def _daily(heavy, light, none, good, normal, bad, worst, weekday, weekend) -> str:
    return f"""d as (
  select day as use_date, rain as rain_day,
    case when rain >= 20 then '{heavy}' when rain > 0 then '{light}' else '{none}' end as rain_class,
    mode_a, mode_b, avg_pm,
    case when avg_pm is null then 'unknown' when avg_pm <= 45 then '{good}'
         when avg_pm <= 50 then '{normal}' when avg_pm <= 55 then '{bad}' else '{worst}' end as dust_grade,
    case when tmax >= 300 then 'heatwave' when tmin <= 0.5 then 'coldwave' else 'normal' end as severe,
    case when isodow(day) >= 6 then '{weekend}' else '{weekday}' end as day_type,
    strftime(day, '%Y%m') as ym
  from m)"""


# The daily condition table, with English and with Korean labels.
DAILY = f"{MERGED},\n" + _daily(
    "heavy", "light", "none", "good", "normal", "bad", "very bad", "weekday", "weekend"
)
DAILY_KOREAN = f"{MERGED},\n" + _daily(
    "많이 옴", "조금 옴", "안 옴", "좋음", "보통", "나쁨", "매우 나쁨", "평일", "주말"
)

# `lineitem` and `orders` rows, and their daily sums, as bindings.trade has them.
TRADE = """a as (
  select cast(l_shipdate as date) as day, l_suppkey as station, cast(l_quantity as bigint) as boardings,
         cast(l_linenumber as bigint) as alightings, cast(round(l_discount * 100) as bigint) as percent,
         l_returnflag as flag
  from lineitem),
b as (
  select o_orderkey as trip, cast(o_orderdate as date) as day, o_orderpriority as station,
         cast(round(o_totalprice * 100) as bigint) as boardings,
         cast(floor(o_totalprice) as bigint) as alightings, o_orderstatus as status
  from orders),
da as (
  select day, cast(sum(boardings) as bigint) as boardings, cast(sum(alightings) as bigint) as alightings,
         cast(sum(boardings) + sum(alightings) as bigint) as mode_a,
         cast(sum(boardings) as double) / count(*) as rain,
         cast(sum(percent) as double) / count(*) as tavg
  from a group by day),
db as (
  select day, cast(sum(boardings) as bigint) as boardings, cast(sum(alightings) as bigint) as alightings,
         cast(sum(boardings) + sum(alightings) as bigint) as mode_b
  from b group by day)"""

# Days of both modes with conditions and labels.
TRADE_DAYS = f"""{TRADE},
x as (
  select da.day, mode_a, mode_b, rain, tavg,
    case when rain >= 27 then 'heavy' when rain > 24 then 'light' else 'none' end as rain_class,
    case when isodow(da.day) >= 6 then 'weekend' else 'weekday' end as day_type
  from da join db on da.day = db.day)"""
