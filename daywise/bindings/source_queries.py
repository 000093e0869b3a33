"""Scans, parsers and sinks: rows of the given tables are written out, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn, operators as op, plans, sinks, sources as src
from ..functions import fixed_values as fv
from ..session import new_folder
from ..streaming import ingest_incremental as ingest, read_ingested
from . import events as ev, feeds, trade as tr
from .registry import DAILY, DAILY_KOREAN, LOG, TRADE, query


def schema_of(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


@query(f"""with {TRADE}
select trip, case when trip % 101 <> 4 then day end as day,
       case when isodow(day) >= 6 then '주말' else '평일' end as day_type,
       case when trip % 101 not in (2, 5) then boardings end as boardings, trip % 101 in (2, 3, 4, 5) as malformed
from b union all select null, null, '평일여부', null, true from b where trip % 101 = 1""")
def scan_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Three folders of one layout: UTF-8 and cp949 with header, cp949 without.

    Some rows are followed by a line equal to the header, some are too short or too long, and in some the day or the
    number is a word; these lines come out with what could be read of them.
    """
    rule = F.col("trip") % 101
    names = ["trip", "사용일자", "평일여부", "승차총승객수"]
    day = F.when(rule == 4, "someday").otherwise(F.date_format("day", "yyyyMMdd"))
    count = F.when(rule == 5, "many").otherwise(F.col("boardings").cast("string"))
    whole = F.concat_ws(",", "trip", day, fn.classify_day_type(F.col("day"), fv.KOREAN), count)
    line = F.when(rule == 2, F.regexp_replace(whole, ",[^,]*$", "")).when(rule == 3, F.concat(whole, F.lit(",7"))).otherwise(whole)
    head = ",".join(names)
    lines = F.array_compact(F.array(line, F.when(rule == 1, head)))
    trips = tr.usage_b(spark, sf).select(F.explode(lines).alias("value"), "status")
    folder = new_folder(spark, "scan-csv")
    schema = schema_of(spark, ", ".join(f"`{n}` {t}" for n, t in zip(names, ("BIGINT", "INT", "STRING", "BIGINT"))))
    parts = []
    for status, charset, header in (("O", "utf-8", True), ("F", "cp949", True), ("P", "cp949", False)):
        path = f"{folder}/{status}"
        feeds.write_lines(trips.filter(F.col("status") == status).select("value"), path, charset, head if header else None)
        parts.append(src.read_csv(spark, path, schema, charset=charset, header=header, corrupt="_line"))
    rows = op.union_by_name(parts)
    return rows.select(
        "trip",
        fn.parse_day(F.col("사용일자")).alias("day"),
        F.col("평일여부").alias("day_type"),
        F.col("승차총승객수").alias("boardings"),
        F.col("_line").isNotNull().alias("malformed"),
    )


@query(f"with {TRADE} select trip, boardings, status || '_' || year(day) as feed from b")
def scan_glob_union(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of files per status and year, picked by name prefix and stacked."""
    trips = tr.usage_b(spark, sf)
    feed = F.concat_ws("_", "status", F.year("day").cast("string"))
    folder = new_folder(spark, "scan-glob")
    (
        trips.select("trip", "boardings", feed.alias("feed"))
        .hint("rebalance", "feed")
        .write.partitionBy("feed")
        .option("header", True)
        .csv(folder)
    )
    schema = schema_of(spark, "trip BIGINT, boardings BIGINT")
    return op.union_by_name(
        [
            src.read_csv(spark, f"{folder}/feed={prefix}_*", schema, glob="*.csv").withColumn(
                "feed", F.regexp_replace(src.source_folder(), "^feed=", "")
            )
            for prefix in ("O", "F", "P")
        ]
    )


TRIPS = "trip BIGINT, day DATE, boardings BIGINT, ym STRING"


def trips_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return tr.usage_b(spark, sf).select(
        "trip", "day", "boardings", fn.month_key(F.col("day")).alias("ym")
    )


@query(f"""with {TRADE}
select trip, day, boardings, strftime(day, '%Y%m') as ym from b
where strftime(day, '%Y%m') between '199603' and '199608'""")
def scan_month(spark: SparkSession, sf: str) -> DataFrame:
    """A range of months of a month-partitioned table."""
    path = new_folder(spark, "month-table")
    sinks.write_month_table(trips_by_month(spark, sf), path)
    return src.scan_month(src.read_month_table(spark, path, TRIPS), "199603", "199608")


@query(f"with {DAILY} select * from d")
def scan_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """The stored daily condition table, read by name."""
    path = new_folder(spark, "daily-table")
    daily = plans.daily_condition_table(ev.merged_in_one_pass(spark, sf), ev.RULES)
    sinks.write_month_table(daily, path)
    spark.sql("DROP TABLE IF EXISTS daywise_daily")
    return sinks.register_table(spark, path, "daywise_daily", plans.DAILY_SCHEMA)


@query(f"""with {LOG}
select day, cast(user_id as integer) as station, reading as pm, event_type as flag from u""")
def parse_ws_text(spark: SparkSession, sf: str) -> DataFrame:
    """Dust text with comments, blank lines and surplus tokens."""
    rows = src.parse_ws_text(spark.read.text(feeds.dust_lines(spark, sf)))
    return op.normalise_dust(rows, keep={"FLAG": "flag"})


@query(f"""with {LOG}
select event_type <> 'error' as width_ok,
       case when event_type <> 'error' then event_id end as "PS_MAX_TM",
       case when event_type <> 'error' then cast(strftime(day, '%Y%m%d') as integer) end as "TM",
       case when event_type <> 'error' then cast(user_id as integer) end as "STN",
       case when event_type <> 'error' then value end as "TA_AVG",
       case when event_type <> 'error' then cast(reading as double) end as "RN_DAY",
       case when event_type <> 'error' then -99.0::double end as "TE_50"
from u""")
def parse_csv_positional(spark: SparkSession, sf: str) -> DataFrame:
    """Weather text of 56 unnamed fields, some lines too short."""
    types = {
        "PS_MAX_TM": "bigint",
        "TM": "int",
        "STN": "int",
        "TA_AVG": "double",
        "RN_DAY": "double",
        "TE_50": "double",
    }
    return src.parse_csv_positional(spark.read.text(feeds.weather_lines(spark, sf)), types)


PAGES = f"""{LOG},
g as (select day, event_type, event_id // 1000 as page,
             case when max(value) >= 250 then 'ERROR-500' when min(value) < 0.1 then 'UNPARSABLE' end as code,
             case when (event_id // 1000) % 2 = 0 then 2 else 1 end as copies, count(*) as n
      from u group by day, event_type, event_id // 1000)"""


@query(f"""with {PAGES}
select u.day, u.event_type, cast(null as varchar) as error_code, event_id, user_id, boardings as cents
from u join g on u.day = g.day and u.event_type = g.event_type and u.event_id // 1000 = g.page
join range(2) t(copy) on copy < copies
where code is null
union all
select day, event_type, code, null, null, null from g join range(2) t(copy) on copy < copies
where code is not null""")
def flatten_json_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = feeds.json_pages(spark, sf)
    return src.flatten_json_pages(pages, feeds.SERVICE, feeds.PAGE_ROW, ["day", "event_type"])


@query(f"""with {PAGES}
select day, event_type, cast(sum(copies) as bigint) as n_pages,
       cast(sum(case when code is null then 0 else copies end) as bigint) as n_failed,
       cast(sum(case when code is null then n else 0 end) as bigint) as n_rows,
       case when count(*) > count(code) then cast(sum(n) as bigint) end as n_announced,
       case when count(code) = 0 then 'complete' else 'incomplete' end as status
from g group by day, event_type""")
def page_completeness(spark: SparkSession, sf: str) -> DataFrame:
    pages = feeds.json_pages(spark, sf)
    return src.page_completeness(pages, feeds.SERVICE, ["day", "event_type"], page="page")


# Row numbers one by one: what of them came, and in how many pages of different start.
@query(f"""with {LOG},
r as (select day, event_type, count(*) as total from u group by day, event_type),
p as (select day, event_type, total, page, page * 50 + 1 - case when page % 5 = 4 then 3 else 0 end as start,
        case when page % 7 = 6 then 0 else least(50, total - page * 50) + case when page % 5 = 4 then 3 else 0 end
          + case when day(day) % 6 = 0 then 5 else 0 end end as n
      from r, unnest(range(0, (total - 1) // 50 + 1)) as t(page)),
i as (select day, event_type, total, unnest(range(start, start + n)) as number from p),
c as (select day, event_type, number, any_value(total) as total, count(*) as times from i group by day, event_type, number),
g as (select day, event_type, cast(sum(times) as bigint) as n_rows, count(*) as present,
             count(case when number between 1 and total then 1 end) as within from c group by day, event_type)
select r.day, r.event_type, total as n_announced, coalesce(n_rows, 0) as n_rows, total - coalesce(within, 0) as n_missing,
       coalesce(n_rows - present, 0) as n_doubled, coalesce(present - within, 0) as n_beyond,
       case when total <> coalesce(within, 0) or present <> within then 'incomplete'
            when n_rows <> present then 'doubled' else 'complete' end as status
from r left join g on r.day = g.day and r.event_type = g.event_type""")
def page_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Missing and doubled rows of requests whose pages leave gaps and overlap."""
    return src.page_intervals(feeds.numbered_pages(spark, sf), feeds.SERVICE, ["day", "event_type"], "start")


STATUS = """case event_type when 'click' then 'utf-8' when 'view' then 'utf-8-sig' when 'purchase' then 'cp949'
  when 'signup' then 'utf-16-le' else 'undecodable' end"""
WORD = """case event_id % 3 when 1 then '짜' when 2 then '쨩'
  else case when isodow(day) >= 6 then '주말' else '평일' end end"""


@query(f"""with {LOG}
select event_type as feed, {STATUS} as status, event_id, {WORD} as day_type, boardings
from u where event_type <> 'error'""")
def recode_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of files in five encodings as text; files with broken bytes are left out."""
    lines, _ = src.recode_lines(spark, feeds.mixed_charsets(spark, sf))
    # The header that some files start with has no number and so no event.
    row = F.from_csv("line", "event_id STRING, day_type STRING, boardings STRING")
    rows = lines.select(
        F.element_at(F.split("file", "/"), -2).alias("feed"), "status", row.alias("r")
    ).select(
        "feed",
        "status",
        F.col("r.event_id").try_cast("bigint").alias("event_id"),
        "r.day_type",
        F.col("r.boardings").try_cast("bigint").alias("boardings"),
    )
    return rows.filter(F.col("event_id").isNotNull())


@query(f"""select event_type as feed, {STATUS} as status
from events group by event_type
union all select 'absent', 'skipped'""")
def recode_status(spark: SparkSession, sf: str) -> DataFrame:
    """What became of each kind of file."""
    path = feeds.mixed_charsets(spark, sf)
    scanned = spark.read.option("recursiveFileLookup", "true").text(path)
    expected = scanned.select(F.col("_metadata.file_path").alias("file")).distinct()
    expected = expected.union(expected.limit(1).select(F.lit(f"{path}/absent/part.csv")))
    status = src.file_status(spark, path, expected=expected)
    feed = F.element_at(F.split("file", "/"), -2).alias("feed")
    return status.select(feed, "status").distinct()


@query(f"""with {LOG}
select event_type as feed, event_id, {WORD} as day_type, boardings
from u where event_type <> 'error'""")
def sink_recoded(spark: SparkSession, sf: str) -> DataFrame:
    """Files of mixed charsets written as UTF-8 with BOM and read again."""
    root = feeds.mixed_charsets(spark, sf)
    lines, _ = src.recode_lines(spark, root)
    path = new_folder(spark, "recoded")
    src.write_recoded(lines, path, root)
    row = F.from_csv("value", "event_id STRING, day_type STRING, boardings STRING").alias("r")
    rows = spark.read.text(path).select(F.element_at(F.split("file", "/"), 1).alias("feed"), row)
    return rows.select(
        "feed",
        F.col("r.event_id").try_cast("bigint").alias("event_id"),
        "r.day_type",
        F.col("r.boardings").try_cast("bigint").alias("boardings"),
    ).filter("event_id is not null")


@query(f"with {TRADE} select trip, day, boardings, strftime(day, '%Y%m') as ym from b")
def sink_month_table(spark: SparkSession, sf: str) -> DataFrame:
    """Write all months, then half of the rows' months again: nothing is doubled."""
    path = new_folder(spark, "month-table")
    trips = trips_by_month(spark, sf)
    sinks.write_month_table(trips, path)
    sinks.write_month_table(trips.filter(F.col("ym") >= "1998"), path)
    return src.read_month_table(spark, path, TRIPS)


@query(f"""with {DAILY_KOREAN}
select use_date as "사용일자", rain_day as "RN_DAY", rain_class as "IS_RAINY", day_type as "평일여부",
       mode_a as "버스승객수", mode_b as "지하철승객수" from d""")
def sink_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    """The published CSV of the stored table: BOM, Korean names and labels."""
    rules = plans.Rules(ev.RULES.heavy_from, ev.RULES.light_above, labels=fv.KOREAN)
    daily = plans.daily_condition_table(ev.merged_in_one_pass(spark, sf), rules)
    table, path = new_folder(spark, "daily-table"), new_folder(spark, "csv-export")
    sinks.write_month_table(daily, table)
    stored = src.read_month_table(spark, table, plans.DAILY_SCHEMA)
    sinks.write_csv(plans.published_names(stored), path, bom=True, even=True)
    names = list(fv.PUBLISHED_NAMES.values())
    types = ("DATE", "DOUBLE", "STRING", "STRING", "BIGINT", "BIGINT")
    ddl = ", ".join(f"`{n}` {t}" for n, t in zip(names, types, strict=True))
    return src.read_csv(spark, path, schema_of(spark, ddl))


@query(f"""with {DAILY}
select * from d where ym = '202401'
union all select * replace ('202312' as ym) from d where dust_grade = 'good'""")
def month_run(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly run on four raw CSV files, run twice beside a stored month that stays as it is."""
    raw = feeds.raw_month(spark, sf, "202401")
    folder = new_folder(spark, "month-run")
    daily = plans.daily_condition_table(ev.merged_in_one_pass(spark, sf), ev.RULES)
    neighbour = daily.filter("dust_grade = 'good'").withColumn("ym", F.lit("202312"))
    sinks.replace_months(neighbour, f"{folder}/table", ["202312"])
    for _ in range(2):
        plans.run_month(
            spark, raw, "202401", f"{folder}/table", f"{folder}/export", ev.STATION, ev.RULES
        )
    return src.read_month_table(spark, f"{folder}/table", plans.DAILY_SCHEMA)


@query(f"""with {DAILY}
select * from d where ym = '202401'
union all select * replace ('202402' as ym) from d where dust_grade = 'good'""")
def year_run(spark: SparkSession, sf: str) -> DataFrame:
    """The yearly run on the files of a month; a part of the bus rows comes as the file of the next one.

    That file is in cp949, in the layout of downloads, its columns in another order. The month after has no other file, so
    what is stored of it stays; a run that meets a file of unknown layout fails and replaces nothing.
    """
    folder = new_folder(spark, "year-run")
    raw = feeds.raw_month(spark, sf, "202401", halves=True)
    daily = plans.daily_condition_table(ev.merged_in_one_pass(spark, sf), ev.RULES)
    stored = daily.filter("dust_grade = 'good'").withColumn("ym", F.lit("202402"))
    sinks.replace_months(stored, f"{folder}/table", ["202402"])
    plans.run_year(spark, raw, "2024", f"{folder}/table", None, ev.STATION, ev.RULES)
    strange = f"{raw}/{fv.INPUT_FILES['subway'].format(month='202403')}"
    feeds.write_lines(ev.log(spark, sf).select(F.col("stamp").alias("value")), strange, header="when,who")
    try:
        plans.run_year(spark, raw, "2024", f"{folder}/table", None, ev.STATION, ev.RULES)
    except plans.UnknownLayout:
        return src.read_month_table(spark, f"{folder}/table", plans.DAILY_SCHEMA)
    raise AssertionError("a file of unknown layout was taken in")


@query(f"""with {LOG}
select event_id, user_id, value, case when event_type = 'error' then 0 else value end as rain from u""")
def sink_csv_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Select, fill, write a CSV folder with header, and again over it."""
    rain = F.when(~ev.kind("error"), F.col("value"))
    rows = ev.log(spark, sf).select("event_id", "user_id", "value", rain.alias("rain"))
    path = new_folder(spark, "csv-overwrite")
    for _ in range(2):
        sinks.write_csv(fn.fill_nulls(rows, {"rain": 0.0}), path)
    schema = schema_of(spark, "event_id BIGINT, user_id BIGINT, value DOUBLE, rain DOUBLE")
    return src.read_csv(spark, path, schema)


@query(f"""with {LOG}
select case when event_type <> 'view' or event_id % 10 <> 0 then event_id end as event_id,
       case when event_type <> 'signup' then day end as day, event_type, boardings,
       case when event_type <> 'signup' then strftime(day, '%Y%m') end as ym,
       case when event_type = 'signup' then 'no day' when event_type = 'view' and event_id % 10 = 0 then 'no key' end as reason
from u""")
def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Day files taken in as a stream, then the weekend days a second time, by a second run with a checkpoint of its own as well.

    Purchases come twice in one file, first with a wrong count. Signups come without a day and some views without a key;
    they are found in the quarantine.
    """
    folder = new_folder(spark, "ingest")
    log = ev.log(spark, sf)
    keyless = ev.kind("view") & (F.col("event_id") % 10 == 0)
    sent = F.when(ev.kind("purchase"), F.array(F.lit(-1).cast("bigint"), F.col("boardings"))).otherwise(F.array("boardings"))
    rows = log.select(
        F.when(~keyless, F.col("event_id")).alias("event_id"), F.when(~ev.kind("signup"), F.col("stamp")).alias("stamp"),
        "event_type", F.explode(sent).alias("boardings"), "day", keyless.alias("keyless"),
    )
    again = rows.filter(fn.is_weekend(F.col("day")) & ~ev.kind("signup") & ~F.col("keyless")).drop("day", "keyless")

    def take_in(run: str) -> None:
        ingest(
            spark,
            landing=f"{folder}/landing",
            landing_schema="event_id BIGINT, stamp STRING, event_type STRING, boardings BIGINT",
            prepare=lambda raw: raw.withColumn("day", fn.day_from_stamp(F.col("stamp")))
            .withColumn("ym", fn.month_key(F.col("day")))
            .drop("stamp"),
            table=f"{folder}/table",
            quarantine=f"{folder}/quarantine-{run}",
            checkpoint=f"{folder}/checkpoint-{run}",
            key=["event_id"],
        )

    rows.drop("day", "keyless").write.mode("append").option("header", True).csv(f"{folder}/landing")
    take_in("first")
    again.write.mode("append").option("header", True).csv(f"{folder}/landing")
    take_in("first")
    take_in("second")
    table = read_ingested(spark, f"{folder}/table", INGESTED, ["event_id"])
    lost = spark.read.schema(f"{INGESTED}, _reason STRING").parquet(f"{folder}/quarantine-first")
    lost = lost.withColumnRenamed("_reason", "reason").drop("batch")
    return table.withColumn("reason", F.lit(None).cast("string")).unionByName(lost)


INGESTED = "event_id BIGINT, event_type STRING, boardings BIGINT, day DATE, ym STRING"
