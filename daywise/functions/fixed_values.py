"""Values that results depend on.

Fixed values: labels, limits, station, column names and formats below must stay
exactly as they are for results to agree with the published daily table.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LabelSet:
    """Category names, each tuple in display order."""

    rain: tuple[str, str, str]
    wet: tuple[str, str]
    dust: tuple[str, str, str, str]
    severe: tuple[str, str, str]
    day_type: tuple[str, str]


# Category labels (heavy, light, none / wet, dry / good .. very bad /
# heatwave, coldwave, normal / weekday, weekend).
KOREAN = LabelSet(
    rain=("많이 옴", "조금 옴", "안 옴"),
    wet=("비/눈", "안 옴"),
    dust=("좋음", "보통", "나쁨", "매우 나쁨"),
    severe=("폭염", "한파", "정상"),
    day_type=("평일", "주말"),
)
ENGLISH = LabelSet(
    rain=("heavy", "light", "none"),
    wet=("wet", "dry"),
    dust=("good", "normal", "bad", "very bad"),
    severe=("heatwave", "coldwave", "normal"),
    day_type=("weekday", "weekend"),
)
UNKNOWN = "unknown"

# Limits.
RAIN_HEAVY_FROM = 20.0
RAIN_LIGHT_ABOVE = 0.0
RAIN_DOWNPOUR_FROM = 80.0
DUST_UP_TO = (30.0, 80.0, 150.0)
HEAT_FROM = 35.0
COLD_TO = -15.0

# The weather station of the city, missing-value codes, page size, formats.
CITY_STATION = 108
MISSING_RAIN = -9.0
MISSING_TEMPERATURE = -99.0
SENTINELS = (MISSING_RAIN, MISSING_TEMPERATURE)
PAGE_ROWS = 1000
DAY_FORMAT = "yyyyMMdd"
MONTH_FORMAT = "yyyyMM"
BOM = "\ufeff"

# Input file names and their charsets.
INPUT_FILES = {
    "bus": "BUS_STATION_BOARDING_MONTH_{month}.csv",
    "subway": "CARD_SUBWAY_MONTH_{month}.csv",
    "weather": "weather_data_{month}.csv",
    "dust": "dust_data_{month}.csv",
}
INPUT_CHARSETS = {"bus": "cp949", "subway": "utf-8", "weather": "cp949", "dust": "cp949"}

# cp949 holds all of euc-kr and more, and files named the latter use it.
CHARSET_ALIASES = {"euc-kr": "cp949"}

# Input column names. Those of bus files depend on where the file is from.
BUS_COLUMNS = {
    "day": ("USE_YMD", "사용일자"),
    "boardings": ("GTON_TNOPE", "승차총승객수"),
    "alightings": ("GTOFF_TNOPE", "하차총승객수"),
}
SUBWAY_COLUMNS = {
    "day": ("사용일자",),
    "boardings": "승차총승객수",
    "alightings": "하차총승객수",
}
DUST_COLUMNS = ("TM", "STN_ID", "PM10", "FLAG")
WEATHER_COLUMNS = (
    "TM", "STN", "WS_AVG", "WR_DAY", "WD_MAX", "WS_MAX", "WS_MAX_TM", "WD_INS",
    "WS_INS", "WS_INS_TM", "TA_AVG", "TA_MAX", "TA_MAX_TM", "TA_MIN", "TA_MIN_TM",
    "TD_AVG", "TS_AVG", "TG_MIN", "HM_AVG", "HM_MIN", "HM_MIN_TM", "PV_AVG", "EV_S",
    "EV_L", "FG_DUR", "PA_AVG", "PS_AVG", "PS_MAX", "PS_MAX_TM", "PS_MIN", "PS_MIN_TM",
    "CA_TOT", "SS_DAY", "SS_DUR", "SS_CMB", "SI_DAY", "SI_60M_MAX", "SI_60M_MAX_TM",
    "RN_DAY", "RN_D99", "RN_DUR", "RN_60M_MAX", "RN_60M_MAX_TM", "RN_10M_MAX",
    "RN_10M_MAX_TM", "RN_POW_MAX", "RN_POW_MAX_TM", "SD_NEW", "SD_NEW_TM", "SD_MAX",
    "SD_MAX_TM", "TE_05", "TE_10", "TE_15", "TE_30", "TE_50",
)

# Output column names of the daily table and of the published CSV.
DAILY_TABLE_NAMES = {
    "rain_class": "is_rainy",
    "mode_a": "bus_passenger",
    "mode_b": "subway_passenger",
    "avg_pm": "avg_pm10",
    "severe": "severe_weather",
    "day_type": "is_weekday",
    "ym": "YYYYMM",
}
PUBLISHED_NAMES = {
    "use_date": "사용일자",
    "rain_day": "RN_DAY",
    "rain_class": "IS_RAINY",
    "day_type": "평일여부",
    "mode_a": "버스승객수",
    "mode_b": "지하철승객수",
}
