"""Incremental load of delivered day files."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest `order`, without the columns of `order`.

    `max_by` combines on the map side, so many copies of one key never meet in one task.
    """
    kept = F.struct(*[c for c in df.columns if c not in (*key, *order)])
    newest = df.groupBy(*key).agg(F.max_by(kept, F.struct(*order)).alias("_r"))
    return newest.select(*key, "_r.*")


ARRIVAL = "_arrival STRUCT<time: TIMESTAMP, file: STRING, block: BIGINT, at: BIGINT>"


def store_batch(
    batch: DataFrame, name: str, table: str, quarantine: str, day: str = "day", key: Sequence[str] = ()
) -> None:
    """Write a batch as a part of its own; written again, it replaces only itself.

    Rows without a day, or with a null in `key`, go to the quarantine with the file they came from and the `_reason`. Nothing
    stored is read or rewritten, so a driver that is lost on the way leaves all earlier rows as they were. Such rows are counted
    while the others are written, and the files are read again only if there are any.
    """
    no_day = F.col(day).isNull()
    no_key = F.lit(False)
    for column in key:
        no_key |= F.col(column).isNull()
    unfit = no_day | no_key
    counted = Observation()
    known = batch.observe(counted, F.count_if(unfit).alias("lost")).filter(~unfit)
    part = f"{table}/batch={name}"
    known.hint("rebalance", day).write.mode("overwrite").partitionBy("ym", day).parquet(part)
    # Adaptive execution leaves out the count where no row is fit. A task that is run again may count twice, but never makes some of none.
    any_fit = not batch.sparkSession.read.schema(known.schema).parquet(part).isEmpty()
    lost = batch.filter("false" if any_fit and counted.get["lost"] == 0 else unfit)
    lost = lost.withColumn("_reason", F.when(no_day, "no day").otherwise("no key"))
    lost.hint("rebalance").write.mode("overwrite").parquet(f"{quarantine}/batch={name}")


def read_ingested(
    spark: SparkSession, table: str, schema: str, key: Sequence[str], days: Column | None = None
) -> DataFrame:
    """The newest row of each key, by time and path of the file it came in and its place in that file.

    `days` is a condition on `day` and `ym`; other partitions are not read. A key stays on its day.
    """
    rows = spark.read.schema(f"{schema}, {ARRIVAL}, batch STRING").parquet(table)
    if days is not None:
        rows = rows.filter(days)
    return latest_per_key(rows.drop("batch"), key, ["_arrival"])


def compact(spark: SparkSession, table: str, schema: str, key: Sequence[str], into: str) -> None:
    """Write the newest rows as one batch of a new table folder; the old one stays until it is given up."""
    rows = spark.read.schema(f"{schema}, {ARRIVAL}, batch STRING").parquet(table).drop("batch")
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), "_arrival").alias("_r")).select("_r.*")
    newest.hint("rebalance", "day").write.partitionBy("ym", "day").parquet(f"{into}/batch=compacted")


def ingest_incremental(
    spark: SparkSession,
    landing: str,
    landing_schema: str,
    prepare: Callable[[DataFrame], DataFrame],
    table: str,
    quarantine: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    key: Sequence[str] = (),
) -> None:
    """Take in all CSV files that came since the last run, then stop; `read_ingested` has the rows.

    `prepare` turns raw rows into the columns of the table, which must include `day` and `ym`, row by row. A row's arrival is the time
    and path of its file, where the part of the file begins that it was read with, and its number among the rows of its
    task: a total order, so of two rows of one key the later line counts, also in one file. Parts
    are named after the checkpoint and the batch, so a run with a fresh checkpoint adds its parts
    beside the old ones, and the newest row of a key is the same. Rows with a null in `key` are kept apart.
    """
    reader = spark.readStream.schema(landing_schema).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    delivered = F.struct(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    rows = prepare(reader.csv(landing).withColumn("_arrival", delivered))
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def store(batch: DataFrame, number: int) -> None:
        # A batch is what its tasks read, line after line, so the number in the task is the order of the lines of a part.
        numbered = batch.withColumn("_arrival", F.col("_arrival").withField("at", F.monotonically_increasing_id()))
        store_batch(numbered, f"{run}-{number}", table, quarantine, key=key)

    query = (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
