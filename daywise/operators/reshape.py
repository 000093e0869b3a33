"""Wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def to_long(
    df: DataFrame, ids: Sequence[str], modes: Mapping[str, str], variable: str, value: str
) -> DataFrame:
    """One row per id and mode; `modes` maps a value column to the name it gets."""
    named = df.select(*ids, *[F.col(column).alias(name) for column, name in modes.items()])
    return named.unpivot(list(ids), list(modes.values()), variable, value)
