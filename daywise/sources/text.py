"""Text answers of the weather service: `#` comments, no header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import DUST_COLUMNS, WEATHER_COLUMNS


def parse_ws_text(
    lines: DataFrame, names: Sequence[str] = DUST_COLUMNS, keep: Sequence[str] = ()
) -> DataFrame:
    """Whitespace-separated lines to named text columns.

    Comment and blank lines are dropped, surplus tokens cut off, missing ones null.
    """
    tokens = lines.filter(~F.startswith("value", F.lit("#")) & (F.trim("value") != "")).select(
        *keep, F.split(F.trim("value"), "\\s+").alias("t")
    )
    return tokens.select(*keep, *[F.get("t", F.lit(i)).alias(n) for i, n in enumerate(names)])


def parse_csv_positional(
    lines: DataFrame,
    types: Mapping[str, str],
    names: Sequence[str] = WEATHER_COLUMNS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Comma-separated lines to the typed columns asked for, found by position.

    `types` maps wanted names to types. `width_ok` tells whether the line had one field per name,
    not counting an empty one after a trailing comma; where it had not, all values are null.
    """
    data = F.substring_index("value", "#", 1)
    rows = lines.filter(F.trim(data) != "").select(*keep, F.split(data, ",").alias("f"))
    trailing = (F.size("f") == len(names) + 1) & (F.trim(F.element_at("f", -1)) == "")
    ok = (F.size("f") == len(names)) | trailing
    position = {name: i for i, name in enumerate(names)}
    return rows.select(
        *keep,
        ok.alias("width_ok"),
        *[
            F.when(ok, F.trim(F.get("f", F.lit(position[name]))).try_cast(kind)).alias(name)
            for name, kind in types.items()
        ],
    )
