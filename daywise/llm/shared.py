"""What several corpus operators need: dense ranks of a total order, word counts, table access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialise

# Java's form of "runs of anything but blank, tab, line feed, vertical tab, form feed, return".
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str) -> Column:
    """Number of words in a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_rank(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the dense rank 0, 1, 2 ... of every row in the order of `keys` (nulls first).

    Rows are range partitioned, in as many partitions as the session begins a shuffle with and adaptive execution leaves,
    sorted, numbered within their partition and written once, so the numbers are fixed; then each partition is moved by the rows before it. The only single task sees
    one row per partition. Keys should end in something that is unique, or a hot value stays in
    one partition.
    """
    numbered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    numbered = materialise(numbered, "ranked")
    part = F.shiftright("_at", 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # One row per partition of the sort, whatever the size of the data.
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_at", "_start")
    )
