from .calendar import calendar_spine, coverage_report, day_bounds, missing_days, month_bounds
from .combine import daily_merge, join_conditions, join_modes, union_by_name
from .daily import (
    daily_mean,
    daily_usage,
    filter_station,
    normalise_dust,
    normalise_usage,
    normalise_weather,
    require_unique,
    station_weather,
)
from .grouped import avg_by_category, box_stats, exact_quantiles, mean_ci, moment_mean, moment_sd, moment_sums
from .reshape import to_long

__all__ = [
    "avg_by_category",
    "box_stats",
    "calendar_spine",
    "coverage_report",
    "daily_mean",
    "daily_merge",
    "daily_usage",
    "day_bounds",
    "exact_quantiles",
    "filter_station",
    "join_conditions",
    "join_modes",
    "mean_ci",
    "missing_days",
    "moment_mean",
    "moment_sd",
    "moment_sums",
    "month_bounds",
    "normalise_dust",
    "normalise_usage",
    "normalise_weather",
    "require_unique",
    "station_weather",
    "to_long",
    "union_by_name",
]
