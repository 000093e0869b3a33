"""Delivered files rendered from the given tables: CSV in several charsets, text, JSON pages."""

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import classify_day_type, in_months
from ..functions.fixed_values import BUS_COLUMNS, INPUT_FILES, KOREAN, SUBWAY_COLUMNS, WEATHER_COLUMNS
from ..session import new_folder
from ..sinks import write_csv
from . import events

SERVICE = "dailyUsage"
PAGE_ROW = "event_id BIGINT, user_id BIGINT, cents BIGINT"


def encode_lines(charset: str):
    @F.pandas_udf("binary")
    def encode(lines: pd.Series) -> pd.Series:
        encoded = "\n".join(lines).encode(charset).split(b"\n") if len(lines) else []
        return pd.Series(encoded, index=lines.index, dtype=object)

    return encode


def headed(header: str):
    """Batches of lines, in each task with the header before the first."""

    def put(batches):
        for i, batch in enumerate(batches):
            yield pa.RecordBatch.from_arrays([pa.array([header] * (i == 0) + batch.column(0).to_pylist(), pa.string())], ["value"])

    return put


def write_lines(df: DataFrame, path: str, charset: str = "utf-8", header: str | None = None) -> None:
    """Write column `value` as lines in any charset, each file with the header; the text writer keeps bytes as they are."""
    if header:
        df = df.mapInArrow(headed(header), "value string")
    if charset != "utf-8":
        df = df.select(encode_lines(charset)("value").cast("string").alias("value"))
    df.write.text(path)


def dust_lines(spark: SparkSession, sf: str) -> str:
    """Whitespace text. Signups bring a comment, views a blank line, errors surplus tokens."""
    log = events.log(spark, sf)
    data = F.concat(
        F.concat_ws("   ", "stamp", "user_id", "reading", "event_type"),
        F.when(events.kind("error"), "  = 1 2").otherwise(""),
    )
    lines = F.array(
        F.when(events.kind("signup"), "# TM STN_ID PM10 FLAG"),
        data,
        F.when(events.kind("view"), " "),
    )
    path = new_folder(spark, "dust-text")
    write_lines(log.select(F.explode(F.array_compact(lines)).alias("value")), path)
    return path


def weather_lines(spark: SparkSession, sf: str) -> str:
    """Comma text of 56 fields and a trailing comma. Errors lack a field, signups bring a comment."""
    log = events.log(spark, sf)
    filled = {
        "TM": F.date_format("day", "yyyyMMdd"),
        "STN": F.col("user_id").cast("string"),
        "TA_AVG": F.col("value").cast("string"),
        "RN_DAY": F.col("reading").cast("string"),
        "PS_MAX_TM": F.col("event_id").cast("string"),
        "TE_05": F.lit("-99.0"),
        "TE_50": F.lit("-99.0"),
    }
    fields = [filled.get(name, F.lit("")) for name in WEATHER_COLUMNS]
    short = F.concat_ws(",", *fields[:-1])
    full = F.concat(F.concat_ws(",", *fields), F.lit(","))
    lines = F.array(
        F.when(events.kind("signup"), "#START7777"),
        F.when(events.kind("error"), short).otherwise(full),
    )
    path = new_folder(spark, "weather-text")
    write_lines(log.select(F.explode(F.array_compact(lines)).alias("value")), path)
    return path


def json_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Stored answers, one per request of (day, kind, page); a page has at most 1,000 rows.

    The service fails on a page that holds a reading of 250 or more, a gateway answers in its place
    where one is below 0.1, and pages of even number are stored twice.
    """
    log = events.log(spark, sf)
    request = ["day", "event_type"]
    page = F.floor(F.col("event_id") / 1000)
    pages = log.groupBy(*request, page.alias("page")).agg(
        F.collect_list(F.struct("event_id", "user_id", F.col("boardings").alias("cents"))).alias("row"),
        F.max("value").alias("highest"),
        F.min("value").alias("lowest"),
    )
    announced = log.groupBy(*request).agg(F.count(F.lit(1)).alias("list_total_count"))
    answer = F.to_json(F.struct(F.struct("list_total_count", "row").alias(SERVICE)))
    failure = F.lit('{"RESULT":{"CODE":"ERROR-500","MESSAGE":"server error"}}')
    path = new_folder(spark, "json-pages")
    body = F.when(F.col("highest") >= 250, failure).when(F.col("lowest") < 0.1, "<html>502</html>").otherwise(answer)
    copies = F.when(F.col("page") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    pages.join(announced, request).select(
        *request, "page", body.alias("body"), F.explode(copies).alias("copy")
    ).drop("copy").write.parquet(path)
    schema = "day DATE, event_type STRING, page BIGINT, body STRING"
    return spark.read.schema(schema).parquet(path)


def numbered_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Stored answers by the row they begin with: 50 rows a page, and a request for each day and kind.

    Every seventh page lacks its rows, every fifth begins three rows early, every fourth is stored twice, and every third of these is
    cut short in its second copy. On every sixth day pages hold five rows more than they should.
    """
    log = events.log(spark, sf)
    request = ["day", "event_type"]
    sizes = log.groupBy(*request).agg(F.count(F.lit(1)).alias("list_total_count"))
    page = F.explode(F.sequence(F.lit(0), F.expr("(list_total_count - 1) div 50"))).alias("page")
    asked = sizes.select(*request, "list_total_count", page)
    early = F.when((F.col("page") % 5 == 4), 3).otherwise(0)
    start = F.col("page") * 50 + 1 - early
    length = F.least(F.lit(50), F.col("list_total_count") - F.col("page") * 50) + early
    length = F.when(F.col("page") % 7 == 6, 0).otherwise(length + F.when(F.day("day") % 6 == 0, 5).otherwise(0))
    copies = F.when(F.col("page") % 4 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = asked.select(
        *request, "list_total_count", "page", start.alias("start"), length.alias("n"), F.explode(copies).alias("copy")
    ).withColumn("n", F.when((F.col("copy") == 1) & (F.col("page") % 3 == 0), F.expr("n div 2")).otherwise(F.col("n")))
    numbers = F.expr("transform(slice(sequence(0, n), 1, n), i -> named_struct('event_id', start + i))")
    answer = F.to_json(F.struct(F.struct("list_total_count", numbers.alias("row")).alias(SERVICE)))
    path = new_folder(spark, "numbered-pages")
    sent.select(*request, F.col("start").cast("bigint").alias("start"), answer.alias("body")).write.parquet(path)
    return spark.read.schema("day DATE, event_type STRING, start BIGINT, body STRING").parquet(path)


def mixed_charsets(spark: SparkSession, sf: str) -> str:
    """One folder per event type: UTF-8, UTF-8 with BOM, cp949, UTF-16, and broken bytes for errors.

    Some of the words are, in cp949, also valid UTF-8 for other letters.
    """
    log = events.log(spark, sf)
    word = odd_word()
    line = F.concat_ws(",", "event_id", word, F.col("boardings").cast("string"))
    path = new_folder(spark, "mixed-charsets")

    def lines(name: str) -> DataFrame:
        return log.filter(events.kind(name)).select(line.alias("value"))

    write_lines(lines("click"), f"{path}/click")
    view = log.filter(events.kind("view")).select("event_id", word.alias("평일여부"), "boardings")
    write_csv(view, f"{path}/view", bom=True)
    write_lines(lines("purchase"), f"{path}/purchase", "cp949")
    signups = log.filter(events.kind("signup")).select("event_id", word.alias("평일여부"), "boardings")
    signups.write.option("header", True).option("encoding", "UTF-16LE").csv(f"{path}/signup")
    torn = F.concat(F.col("value").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    lines("error").select(torn.alias("value")).write.text(f"{path}/error")
    return path


def odd_word() -> Column:
    """The type of the day, or a word whose cp949 bytes are UTF-8 for something else."""
    third = F.col("event_id") % 3
    return F.when(third == 1, "짜").when(third == 2, "쨩").otherwise(classify_day_type(F.col("day"), KOREAN))


def raw_month(spark: SparkSession, sf: str, month: str, halves: bool = False) -> str:
    """The four raw CSV files of a month, under their published names and columns.

    `halves` splits the bus file in two, as of this month and the next; the second has the column
    names of downloads, in another order, and is in cp949.
    """
    log = events.log(spark, sf).filter(in_months(F.col("day"), month))
    number = F.date_format("day", "yyyyMMdd")
    path = new_folder(spark, "raw-month")

    def usage(name: str, columns, layout: int = 0) -> None:
        names = [columns[k] if isinstance(columns[k], str) else columns[k][layout] for k in ("day", "boardings", "alightings")]
        day, boardings, alightings = names
        rows = log.filter(events.kind(name)).select(
            number.alias(day), F.col("boardings").alias(boardings), F.col("alightings").alias(alightings), "event_id"
        )
        part = f"{path}/{files[name].format(month=str(int(month) + layout))}"
        if layout:
            names = [alightings, day, boardings]
            lines = rows.filter("event_id % 2 = 1").select(F.concat_ws(",", *[f"`{n}`" for n in names]).alias("value"))
            write_lines(lines, part, "cp949", ",".join(names))
            return
        if halves and name == "click":
            rows = rows.filter("event_id % 2 = 0")
        write_csv(rows.drop("event_id"), part)

    files = {"click": INPUT_FILES["bus"], "view": INPUT_FILES["subway"]}
    usage("click", BUS_COLUMNS)
    if halves:
        usage("click", BUS_COLUMNS, layout=1)
    usage("view", SUBWAY_COLUMNS)
    weather = events.weather(log).select(
        number.alias("TM"),
        F.col("station").alias("STN"),
        F.col("tavg").alias("TA_AVG"),
        F.col("tmax").alias("TA_MAX"),
        F.col("tmin").alias("TA_MIN"),
        F.col("rain").alias("RN_DAY"),
    )
    write_csv(weather, f"{path}/{INPUT_FILES['weather'].format(month=month)}")
    dust = log.filter(events.kind("error")).select(
        F.col("stamp").alias("TM"), F.col("station").alias("STN_ID"), events.dust_text().alias("PM10")
    )
    write_csv(dust, f"{path}/{INPUT_FILES['dust'].format(month=month)}")
    return path
