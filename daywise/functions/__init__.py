from .classify import (
    category_ordinal,
    classify_day_type,
    classify_dust,
    classify_rain,
    classify_severe,
    classify_wet,
)
from .cleaning import cast_lenient, fill_nulls, null_sentinels
from .dates import (
    day_from_stamp,
    in_months,
    is_weekend,
    month_key,
    parse_day,
    parse_day_lenient,
    previous_day,
)

__all__ = [
    "cast_lenient",
    "category_ordinal",
    "classify_day_type",
    "classify_dust",
    "classify_rain",
    "classify_severe",
    "classify_wet",
    "day_from_stamp",
    "fill_nulls",
    "in_months",
    "is_weekend",
    "month_key",
    "null_sentinels",
    "parse_day",
    "parse_day_lenient",
    "previous_day",
]
