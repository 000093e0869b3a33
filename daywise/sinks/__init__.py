"""Month-partitioned tables and CSV exports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fixed_values import BOM


def write_month_table(
    df: DataFrame, path: str, key: str = "ym", fmt: str = "parquet", rebalance: bool = True
) -> None:
    """Replace the months that `df` holds, leave all others: a re-run changes nothing.

    Rebalancing gives each month few files of even size and splits a month that is much larger
    than the rest, so no task writes a whole hot month. It shuffles the rows: switch it off for a
    large input that already lies month by month.
    """
    rows = df.hint("rebalance", key) if rebalance else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .format(fmt)
        .save(path)
    )


def replace_months(df: DataFrame, path: str, months: Sequence[str], key: str = "ym") -> None:
    """Replace exactly the given months of a Parquet table by what `df` has of them.

    Months with rows are written in one dynamic overwrite, which puts all of them in place when the job commits; then
    months without rows are emptied. All others stay as they are. `df` is read twice: give it
    daily rows that are written already.
    """
    rows = df.filter(F.col(key).isin(list(months)))
    present = {r[0] for r in rows.select(key).distinct().collect()}
    if present:
        write_month_table(rows, path, key)
    for month in sorted(set(months) - present):
        df.filter("false").drop(key).write.mode("overwrite").parquet(f"{path}/{key}={month}")


def write_csv(df: DataFrame, path: str, bom: bool = False, even: bool = False) -> None:
    """Overwrite a folder of CSV parts, each with header.

    `bom` starts each part with a byte order mark. `even` brings rows together in parts of about
    the advisory size, however many there are: daily rows come out as one part.
    """
    if even:
        df = df.hint("rebalance")
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    df.write.mode("overwrite").option("header", True).csv(path)


def register_table(
    spark: SparkSession, path: str, name: str, schema: str, key: str = "ym", fmt: str = "parquet"
) -> DataFrame:
    """Make a stored month table known to the catalog by name, with all its months, and scan it.

    The table is external: dropping it leaves the files. A name that already stands for another folder is refused.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING {fmt} "
        f"PARTITIONED BY (`{key}`) LOCATION '{path}'"
    )
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    known = described.data_type if described else None
    if known is None or bare_path(known) != bare_path(path):
        raise ValueError(f"{name} already stands for {known}, not for {path}: drop it or take another name")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def bare_path(path: str) -> str:
    """A path to compare: local ones are written with or without a scheme, and with one slash or three."""
    return unquote(re.sub("^file:/+", "/", path)).rstrip("/")
