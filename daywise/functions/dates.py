"""Day parsing and calendar expressions. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import DAY_FORMAT, MONTH_FORMAT


def parse_day(raw: Column) -> Column:
    """`20250131` (number or text) to DATE; malformed input is an error."""
    return F.to_date(raw.cast("string"), DAY_FORMAT)


def parse_day_lenient(raw: Column) -> Column:
    """As `parse_day`, but malformed input gives null."""
    return F.try_to_date(raw.cast("string"), DAY_FORMAT)


def day_from_stamp(raw: Column) -> Column:
    """DATE from the leading eight digits of a `yyyyMMddHHmm` stamp."""
    return F.to_date(F.substring(raw.cast("string"), 1, 8), DAY_FORMAT)


def month_key(day: Column) -> Column:
    return F.date_format(day, MONTH_FORMAT)


def in_months(day: Column, first: str, last: str | None = None) -> Column:
    """True for days of the months `first`..`last` (`yyyyMM`).

    Written as a range of days, it is pushed down to the scan, also of a timestamp cast to a day.
    """
    start = F.to_date(F.lit(f"{first}01"), DAY_FORMAT)
    end = F.add_months(F.to_date(F.lit(f"{last or first}01"), DAY_FORMAT), 1)
    return (day >= start) & (day < end)


def is_weekend(day: Column) -> Column:
    """True on Saturday and Sunday (`dayofweek` counts from Sunday = 1)."""
    return F.dayofweek(day).isin(1, 7)


def previous_day() -> Column:
    return F.date_sub(F.current_date(), 1)
