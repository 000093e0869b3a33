"""CSV files, one or many, in any charset, and stored month tables."""

from __future__ import annotations

import csv
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import CHARSET_ALIASES
from .charset import raw_lines

# Charsets the CSV reader takes; others are decoded before it parses.
READER_CHARSETS = {"utf-8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32"}


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    charset: str = "utf-8",
    header: bool = True,
    glob: str | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """Scan CSV files with explicit types, never an inference pass over the data.

    Without a schema only the header line of one file is looked at and every column is text; files read
    together must have the same columns in the same order. `glob` keeps the files with a matching
    name. The first line of each file is its header, wherever it stands; a later line that is equal to it is
    a row. `corrupt` names a column that holds the line of a row that is too short, too long or of another type,
    and null for a sound one; the values that could be read are in their columns either way.

    The charset alone decides how lines are decoded, whatever the session is set to: the CSV reader takes some, for
    others a task decodes the lines it reads, and the same parser follows (no line breaks inside quotes there; a line that is
    not valid in the charset fails the job).
    """
    charset = CHARSET_ALIASES.get(charset.lower(), charset.lower())
    charset = {"utf-16-le": "utf-16le", "utf-16-be": "utf-16be", "utf-8-sig": "utf-8"}.get(charset, charset)
    if charset in READER_CHARSETS:
        reader = spark.read.options(header=header, encoding=charset, **({"pathGlobFilter": glob} if glob else {}))
        if charset in ("utf-16le", "utf-16be"):
            reader = reader.option("lineSep", "\n")
        if schema is None and corrupt:
            schema = reader.csv(paths).schema
        if corrupt:
            reader = reader.options(columnNameOfCorruptRecord=corrupt, columnPruning=False)
            schema = T.StructType([*schema, T.StructField(corrupt, T.StringType())])
        return (reader.schema(schema) if schema else reader).csv(paths)
    lines = raw_lines(spark, paths, glob, nested=False)
    if schema is None:
        if not header:
            raise ValueError("a schema is needed where there is no header")
        first = lines.filter("block = 0").select(F.col("value").cast("binary").alias("line")).first()
        names = next(csv.reader([bytes(first.line).decode(charset)])) if first else []
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    partitions = [c for c in lines.columns if c not in ("value", "file", "block", "at", "size")]
    text = _decoded_rows(lines.select(F.col("value").cast("binary").alias("line"), "file", "block", *partitions), charset, header)
    fields = [*schema, T.StructField(corrupt, T.StringType())] if corrupt else schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    options = {"columnNameOfCorruptRecord": corrupt} if corrupt else {}
    rows = text.filter(F.trim("line") != "").select(F.from_csv("line", ddl, options).alias("r"), *partitions)
    return rows.select("r.*", *partitions)


def _decoded_rows(lines: DataFrame, charset: str, header: bool) -> DataFrame:
    """`line` as text, in place; without the first line of each file, if that is the header.

    A task reads the lines of a part of a file one after the other, so a header is the first line of a part that
    begins at 0.
    """
    kinds = {f.name: f.dataType.simpleString() for f in lines.schema}
    kinds["line"] = "string"

    def decode(batches):
        last = None
        for batch in batches:
            parts = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
            raw = batch.column("line").to_pylist()
            kept = []
            for i, part in enumerate(parts):
                if not (header and part != last and part[1] == 0):
                    kept.append(i)
                last = part
            text = b"\n".join(raw[i] for i in kept).decode(charset).split("\n") if kept else []
            rest = batch.take(pa.array(kept, pa.int64()))
            columns = [pa.array(text, pa.string()) if name == "line" else rest.column(name) for name in kinds]
            yield pa.RecordBatch.from_arrays(columns, list(kinds))

    return lines.mapInArrow(decode, ", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))


def keep_sound(rows: DataFrame, corrupt: str, quarantine: str) -> DataFrame:
    """The sound rows of a frame read with `corrupt`; the others are written to a folder as they came.

    The folder has a Parquet table with the line and what could be read of it, written anew each time.
    """
    bad = F.col(corrupt).isNotNull()
    rows.filter(bad).write.mode("overwrite").parquet(quarantine)
    return rows.filter(~bad).drop(corrupt)


def source_folder(depth: int = 1) -> F.Column:
    """Name of the folder a scanned row's file lies in, as lineage of many-file scans."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1 - depth)


def scan_month(table: DataFrame, first: str, last: str | None = None, key: str = "ym") -> DataFrame:
    """Rows of the months `first`..`last`; on a month-partitioned table only they are read."""
    if last is None:
        return table.filter(F.col(key) == first)
    return table.filter(F.col(key).between(first, last))


def read_month_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A table written by `sinks.write_month_table`; the schema keeps the month key as text."""
    return spark.read.schema(schema).format(fmt).load(path)
