"""Null and type handling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .fixed_values import SENTINELS


def cast_lenient(raw: Column, to: str) -> Column:
    """Cast; text that does not parse gives null also in ANSI mode."""
    return raw.try_cast(to)


def null_sentinels(value: Column, sentinels: Iterable[float] = SENTINELS) -> Column:
    """Replace the codes that stand for "not measured" by null."""
    return F.when(~value.isin(*sentinels), value)


def fill_nulls(df: DataFrame, constants: Mapping[str, float | int | str]) -> DataFrame:
    """Per-column constant for nulls; an unknown column name is an error."""
    unknown = sorted(set(constants) - set(df.columns))
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    return df.na.fill(dict(constants))
