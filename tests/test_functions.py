"""Boundaries of labels, dates and casts."""

import datetime

import pytest
from pyspark.sql import functions as F

from daywise import functions as fn
from daywise.functions import fixed_values as fv


def values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def numbered(rows, kind, items):
    return rows(f"i INT, v {kind}", list(enumerate(items)))


def test_rain_bounds(rows):
    df = numbered(rows, "DOUBLE", [-9.0, None, 0.0, 0.1, 19.9, 20.0])
    got = values(df, fn.classify_rain(F.col("v")))
    assert got == ["none", "none", "none", "light", "light", "heavy"]
    korean = values(df, fn.classify_rain(F.col("v"), labels=fv.KOREAN))
    assert korean == ["안 옴", "안 옴", "안 옴", "조금 옴", "조금 옴", "많이 옴"]


def test_wet_bounds(rows):
    df = numbered(rows, "DOUBLE", [-9.0, None, 0.0, 0.1])
    assert values(df, fn.classify_wet(F.col("v"))) == ["dry", "dry", "dry", "wet"]


def test_dust_bounds(rows):
    df = numbered(rows, "DOUBLE", [30.0, 30.1, 80.0, 80.1, 150.0, 150.1, None])
    grades = ["good", "normal", "normal", "bad", "bad", "very bad"]
    assert values(df, fn.classify_dust(F.col("v"))) == [*grades, "unknown"]
    through = fn.classify_dust(F.col("v"), null_label="very bad")
    assert values(df, through) == [*grades, "very bad"]


def test_severe_bounds(rows):
    df = rows(
        "i INT, hi DOUBLE, lo DOUBLE",
        [(0, 35.0, 20.0), (1, 34.9, 20.0), (2, 0.0, -15.0), (3, 36.0, -16.0), (4, None, None), (5, 0.0, -14.9)],
    )
    got = values(df, fn.classify_severe(F.col("hi"), F.col("lo")))
    assert got == ["heatwave", "normal", "coldwave", "heatwave", "normal", "normal"]


def test_sentinel_temperature_is_not_cold(rows):
    df = rows("i INT, hi DOUBLE, lo DOUBLE", [(0, 3.0, -99.0)])
    assert values(df, fn.classify_severe(F.col("hi"), F.col("lo"))) == ["coldwave"]
    clean = fn.classify_severe(F.col("hi"), fn.null_sentinels(F.col("lo")))
    assert values(df, clean) == ["normal"]


def test_day_type(rows):
    days = [datetime.date(2025, 1, d) for d in (3, 4, 5, 6)]
    df = numbered(rows, "DATE", days)
    assert values(df, fn.classify_day_type(F.col("v"))) == ["weekday", "weekend", "weekend", "weekday"]


def test_year_2025_has_261_weekdays(spark):
    days = spark.sql("select explode(sequence(date'2025-01-01', date'2025-12-31')) as d")
    counts = dict(days.groupBy(fn.classify_day_type(F.col("d"))).count().collect())
    assert counts == {"weekday": 261, "weekend": 104}


def test_days(rows):
    df = numbered(rows, "STRING", ["20250131", "2025xx01", "20250230", None])
    jan31 = datetime.date(2025, 1, 31)
    assert values(df, fn.parse_day_lenient(F.col("v"))) == [jan31, None, None, None]
    assert values(df.filter("i = 0"), fn.parse_day(F.col("v"))) == [jan31]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|DATETIME"):
        values(df.filter("i = 1"), fn.parse_day(F.col("v")))


def test_day_from_number_stamp(rows):
    df = numbered(rows, "BIGINT", [202501312359])
    assert values(df, fn.day_from_stamp(F.col("v"))) == [datetime.date(2025, 1, 31)]


def test_month_key_and_previous_day(spark, rows):
    df = numbered(rows, "DATE", [datetime.date(2025, 1, 31)])
    assert values(df, fn.month_key(F.col("v"))) == ["202501"]
    assert spark.range(1).select(fn.previous_day() == F.date_sub(F.current_date(), 1)).first()[0]


def test_months_are_pushed_down(spark, rows):
    days = [datetime.date(2024, 11, 30), datetime.date(2024, 12, 1), datetime.date(2025, 1, 31), datetime.date(2025, 2, 1)]
    df = numbered(rows, "DATE", days)
    assert values(df.filter(fn.in_months(F.col("v"), "202412", "202501")), "v") == days[1:3]
    assert values(df.filter(fn.in_months(F.col("v"), "202412")), "v") == days[1:2]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    march = orders.filter(fn.in_months(F.col("o_orderdate").cast("date"), "199603"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        pushed = march._jdf.queryExecution().executedPlan().toString().partition("PushedFilters")[2]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate,1996-03-01" in pushed
    assert "LessThan(o_orderdate,1996-04-01" in pushed


def test_lenient_cast(rows):
    df = numbered(rows, "STRING", ["4", "4x", "", None])
    assert values(df, fn.cast_lenient(F.col("v"), "int")) == [4, None, None, None]


def test_sentinels_then_fill(rows):
    df = numbered(rows, "DOUBLE", [-9.0, -99.0, 0.0, 3.5, None])
    clean = df.withColumn("v", fn.null_sentinels(F.col("v")))
    assert values(clean, "v") == [None, None, 0.0, 3.5, None]
    assert values(fn.fill_nulls(clean, {"v": 0.0}), "v") == [0.0, 0.0, 0.0, 3.5, 0.0]


def test_fill_refuses_unknown_column(rows):
    with pytest.raises(ValueError, match="PM_10"):
        fn.fill_nulls(numbered(rows, "DOUBLE", [1.0]), {"PM_10": 0})


def test_ordinal(rows):
    df = numbered(rows, "STRING", ["heavy", "none", "hail", None])
    assert values(df, fn.category_ordinal(F.col("v"), fv.ENGLISH.rain)) == [1, 3, None, None]


def test_weather_has_56_columns():
    assert len(fv.WEATHER_COLUMNS) == len(set(fv.WEATHER_COLUMNS)) == 56
