from .daily_condition import (
    DAILY_SCHEMA,
    Roles,
    Rules,
    daily_condition_table,
    days_with_temperature,
    label_days,
    merge_inputs,
    merge_log,
    published_names,
    table_names,
)
from .month_run import UnknownLayout, read_inputs, run_month, run_year
from .reports import (
    heavy_rain_days,
    mean_use_by,
    report_dust,
    report_rain,
    report_severe,
    report_temp_sensitivity,
    report_year_rain,
    station_profile,
)

__all__ = [
    "DAILY_SCHEMA",
    "Roles",
    "Rules",
    "UnknownLayout",
    "daily_condition_table",
    "days_with_temperature",
    "heavy_rain_days",
    "label_days",
    "mean_use_by",
    "merge_inputs",
    "merge_log",
    "published_names",
    "read_inputs",
    "report_dust",
    "report_rain",
    "report_severe",
    "report_temp_sensitivity",
    "report_year_rain",
    "run_month",
    "run_year",
    "station_profile",
    "table_names",
]
