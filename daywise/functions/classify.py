"""Labels for a day. Limits and label sets are arguments; defaults are the fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from . import fixed_values as fv
from .dates import is_weekend


def classify_rain(
    rain: Column,
    heavy_from: float = fv.RAIN_HEAVY_FROM,
    light_above: float = fv.RAIN_LIGHT_ABOVE,
    labels: fv.LabelSet = fv.ENGLISH,
) -> Column:
    """Three levels. Null and negative codes count as the driest level."""
    heavy, light, none = labels.rain
    return F.when(rain >= heavy_from, heavy).when(rain > light_above, light).otherwise(none)


def classify_wet(
    rain: Column, above: float = fv.RAIN_LIGHT_ABOVE, labels: fv.LabelSet = fv.ENGLISH
) -> Column:
    wet, dry = labels.wet
    return F.when(rain > above, wet).otherwise(dry)


def classify_dust(
    pm: Column,
    up_to: Sequence[float] = fv.DUST_UP_TO,
    labels: fv.LabelSet = fv.ENGLISH,
    null_label: str | None = fv.UNKNOWN,
) -> Column:
    """Four grades by inclusive upper limits.

    A missing mean gets `null_label`; pass the last grade to have it fall through instead.
    """
    grade = F.when(pm.isNull(), F.lit(null_label))
    for limit, label in zip(up_to, labels.dust[:-1], strict=True):
        grade = grade.when(pm <= limit, label)
    return grade.otherwise(labels.dust[-1])


def classify_severe(
    tmax: Column,
    tmin: Column,
    heat_from: float = fv.HEAT_FROM,
    cold_to: float = fv.COLD_TO,
    labels: fv.LabelSet = fv.ENGLISH,
) -> Column:
    """Heat wins over cold; missing temperatures count as normal."""
    heat, cold, normal = labels.severe
    return F.when(tmax >= heat_from, heat).when(tmin <= cold_to, cold).otherwise(normal)


def classify_day_type(day: Column, labels: fv.LabelSet = fv.ENGLISH) -> Column:
    weekday, weekend = labels.day_type
    return F.when(is_weekend(day), weekend).otherwise(weekday)


def category_ordinal(label: Column, order: Sequence[str]) -> Column:
    """1-based place of a label in a fixed order; null for a label that is not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), label).cast("int"), F.lit(0))
