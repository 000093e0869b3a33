"""Shards along a Hilbert curve over document metadata, in DataFrame operations only.

Each dimension is quantised to `BITS` bits by its own quantiles. The curve index of a cell (Skilling's
transform, 2004) orders the rows, and runs of equal count are cut from that order: a shard covers a
compact region of all dimensions at once, so files can be skipped by any of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .shared import with_rank

BITS = 5
SHARDS = 8
# Of quantiles; the sketch's size depends on it alone.
ACCURACY = 10_000


def default_dimensions(text: str = "text", lang: str = "lang", source: str = "source") -> dict[str, Column]:
    """Source and language by name, and the text's length in bytes."""
    return {"source": F.col(source), "lang": F.col(lang), "bytes": F.octet_length(F.col(text)).cast("double")}


def with_ordinals(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows with each text column replaced by the rank of its value among all distinct ones; null stays null.

    Whole values are compared, in code point order. Distinct values are found before they are sorted, and are joined back; adaptive
    execution splits a value that most rows have.
    """
    for name in names:
        values = materialise(rows.select(F.col(name).alias("_value")).dropna().distinct(), "values")
        ranks = with_rank(values, ["_value"], "_ordinal")
        joined = rows.join(ranks, F.col(name) == F.col("_value"), "left")
        rows = joined.withColumn(name, F.col("_ordinal").cast("double")).drop("_value", "_ordinal")
    return rows


def hilbert_index(axes: Column, n: int, bits: int) -> Column:
    """Place on the Hilbert curve of a cell, given as an array of `n` ints of `bits` bits each."""
    zero = F.lit(0)

    def put(cell: Column, at: Column, value: Column) -> Column:
        return F.transform(cell, lambda x, i: F.when(i == at, value).otherwise(x))

    def undo(cell: Column, q: Column) -> Column:
        """One level of the curve taken back: reflect or exchange axes."""

        def axis(now: Column, i: Column) -> Column:
            here, first, p = F.get(now, i), F.get(now, zero), q - 1
            swap = first.bitwiseXOR(here).bitwiseAND(p)
            reflected = put(now, zero, first.bitwiseXOR(p))
            exchanged = put(put(now, zero, first.bitwiseXOR(swap)), i, F.when(i == 0, first.bitwiseXOR(swap)).otherwise(here.bitwiseXOR(swap)))
            return F.when(here.bitwiseAND(q) != 0, reflected).otherwise(exchanged)

        return F.aggregate(F.sequence(zero, F.lit(n - 1)), cell, axis)

    def gray(now: Column, i: Column) -> Column:
        return put(now, i, F.get(now, i).bitwiseXOR(F.get(now, i - 1)))

    levels = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    cell = F.aggregate(levels, axes, undo)
    if n > 1:
        cell = F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), cell, gray)
    flip = F.aggregate(
        levels, F.struct(cell.alias("cell"), zero.alias("flip")),
        lambda s, q: F.struct(
            s["cell"].alias("cell"),
            F.when(F.get(s["cell"], F.lit(n - 1)).bitwiseAND(q) != 0, s["flip"].bitwiseXOR(q - 1)).otherwise(s["flip"]).alias("flip"),
        ),
        lambda s: F.transform(s["cell"], lambda x: x.bitwiseXOR(s["flip"])),
    )
    # Bits of all axes in turn, from the highest level down.
    taken = F.flatten(F.transform(F.sequence(F.lit(bits - 1), zero, F.lit(-1)), lambda b: F.transform(flip, lambda x: F.getbit(x, b).cast("long"))))
    return F.aggregate(taken, F.lit(0).cast("long"), lambda h, bit: h * 2 + bit)


def quantised(rows: DataFrame, dimensions: Mapping[str, Column], bits: int, accuracy: int = ACCURACY) -> dict[str, Column]:
    """A column of 0 to 2^bits - 1 for each dimension: how many of its quantiles lie below; null gives 0.

    One aggregate over all rows; the driver gets 2^bits - 1 numbers for each dimension.
    """
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(c, steps, accuracy).alias(k) for k, c in dimensions.items()]).first()
    found = {}
    for name, value in dimensions.items():
        below = F.array(*[F.lit(float(x)) for x in sorted(set(cuts[name] or []))]).cast("array<double>")
        found[name] = F.coalesce(F.size(F.filter(below, lambda x: x < value)), F.lit(0))
    return found


def shard(
    docs: DataFrame, dimensions: Mapping[str, Column] | None = None, shards: int = SHARDS, bits: int = BITS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """A row for each document: doc_id, size, text_crc32, hilbert, shard, slot.

    Rows are ordered by curve index, then text checksum, size and id; shards are runs of this order whose
    counts are at most one apart, and `slot` counts from 0 in each. Copies that agree in metadata
    are next to each other. `dimensions` are columns of numbers or texts; texts go by the rank of their whole value. `size` is UTF-8 bytes plus 1; null texts have none. Null metadata sorts
    first. Repeated rows have slots of their own; an empty table gives no rows. The texts are read,
    but only narrow rows are shuffled; the order ends in the id, so no value is too hot to split.
    """
    dimensions = dimensions or default_dimensions(text)
    whole = F.coalesce(F.col(text), F.lit(""))
    names = [f"_axis{i}" for i in range(len(dimensions))]
    # Written once: texts are not read and hashed again.
    narrow = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(F.encode(whole, "utf-8")).alias("text_crc32"),
            *[column.alias(name) for name, column in zip(names, dimensions.values())],
        ),
        "rows",
    )
    narrow = with_ordinals(narrow, [f.name for f in narrow.schema if f.name in names and f.dataType.typeName() == "string"])
    narrow = materialise(narrow, "axes")
    axes = quantised(narrow, {name: F.col(name).cast("double") for name in names}, bits)
    cell = F.array(*[axes[name].cast("int") for name in names])
    cells = narrow.select("doc_id", "size", "text_crc32", hilbert_index(cell, len(names), bits).alias("hilbert"))
    ranked = with_rank(materialise(cells, "cells"), ["hilbert", "text_crc32", "size", "doc_id"], "rank")
    ranked = materialise(ranked, "order")
    rows = ranked.count()
    # Shard s begins at the first rank r with floor(r x shards / rows) = s.
    number = F.expr(f"(rank * {shards}) div {max(rows, 1)}")
    first = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", number.cast("int")).withColumn("slot", F.col("rank") - first)
        .select("doc_id", "size", "text_crc32", "hilbert", "shard", "slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Write whole rows to one folder for each shard, in slot order within each file.

    Ids must be unique. A shard is split by ranges of slots over several tasks and files.
    """
    known = placed.select(F.col(doc_id), "hilbert", "shard", "slot")
    rows = docs.join(known, doc_id).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(path)
