"""Charset detection and decoding for text files that arrive in mixed encodings.

Files are scanned as lines of raw bytes, so a large one is split over many tasks. What charset a
file is in is an aggregate over all of its lines, and combines before the shuffle; only then are lines decoded, all lines
of a file in the same way. Only lines with bytes beyond ASCII go through Python, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.fixed_values import BOM
from ..session import materialise

UNDECODABLE, SKIPPED = "undecodable", "skipped"
# Charsets of two bytes a character, by the bytes their files begin with; the line feed tells them apart otherwise.
WIDE = {"utf-16-le": "FFFE", "utf-16-be": "FEFF"}


def decode_lines(charset: str, strict: bool = False):
    """Arrow UDF from bytes to text. A line not valid in `charset` gives null, or fails if `strict`."""

    @F.pandas_udf("string")
    def decode(lines: pd.Series) -> pd.Series:
        present = lines.dropna()
        return pd.Series(_decoded(present, charset, strict), index=present.index, dtype=object).reindex(lines.index)

    return decode


def _decoded(lines: pd.Series, charset: str, strict: bool) -> list[str | None]:
    """Each line as text, null where it is not valid."""

    def one(line):
        try:
            return line.decode(charset)
        except UnicodeDecodeError:
            if strict:
                raise
            return None

    if charset in WIDE:
        return [one(line) for line in lines]
    try:
        # The whole batch in one call; lines hold no line feed.
        return b"\n".join(lines).decode(charset).split("\n") if len(lines) else []
    except UnicodeDecodeError:
        return [one(line) for line in lines]


def raw_lines(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None, charset: str | None = None, nested: bool = True
) -> DataFrame:
    """(value, file, block, at, size): lines as undecoded bytes in a string column.

    A line's place in its file is `block`, where the part begins that it was read with, and `at` among the lines
    of a task; `size` is that of the file. Lines end at line feeds, carriage returns or both, and a UTF-8 mark is
    skipped. With a `charset` of `WIDE` or `utf-8` they end at that charset's line feed alone. Files in folders of folders
    are read as well, or else (not `nested`) columns follow for folders named `key=value`.
    """
    options = {"recursiveFileLookup": str(nested).lower()} | ({"pathGlobFilter": glob} if glob else {})
    if charset:
        options |= {"lineSep": "\n", "encoding": charset.replace("utf-16-", "utf-16")}
    lines = spark.read.options(**options).text(path)
    return lines.select(
        *lines.columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_size").alias("size"),
    )


def _ascii() -> Column:
    return F.is_valid_utf8("value") & (F.length("value") == F.octet_length("value"))


def _decodable(charsets: Sequence[str]):
    """Arrow UDF from bytes to a number with a bit for each charset the line is valid in."""

    @F.pandas_udf("long")
    def decodable(lines: pd.Series) -> pd.Series:
        present = lines.dropna()
        bits = pd.Series(0, index=present.index)
        for i, charset in enumerate(charsets):
            bits += [(text is not None) << i for text in _decoded(present, charset, False)]
        return bits.reindex(lines.index).astype("Int64")

    return decodable


def file_profile(
    spark: SparkSession, path: str | Sequence[str], fallbacks: str | Sequence[str] = "cp949", glob: str | None = None
) -> DataFrame:
    """(file, status, header) for every file with a byte; `header` is its first line, undecoded.

    One scan, one row per file and task in the shuffle. The status is `utf-16-le` or `utf-16-be`, if the file begins with such
    a mark, or most of its lines have a zero byte beside the line feed; else `utf-8-sig` or `utf-8` if all lines are
    valid (with a mark, three bytes of the file are in no line; a compressed file's mark goes unseen); else the first of `fallbacks` in which all lines
    decode, which must hold ASCII as it is; else `undecodable`.
    """
    charsets = [fallbacks] if isinstance(fallbacks, str) else list(fallbacks)
    lines = raw_lines(spark, path, glob, "utf-8")
    raw = F.col("value").cast("binary")
    beyond = F.when(~_ascii(), raw)
    place = F.struct("block", "at")
    seen = lines.select(
        "file", "size", "value", place.alias("place"), F.is_valid_utf8("value").alias("utf8"),
        F.coalesce(_decodable(charsets)(beyond), F.lit((1 << len(charsets)) - 1)).alias("bits"),
    )
    known = seen.groupBy("file").agg(
        F.max("size").alias("size"), F.sum(F.octet_length("value") + 1).alias("in_lines"), F.count("*").alias("n"),
        F.bool_and("utf8").alias("utf8"), F.bit_and("bits").alias("bits"),
        F.count_if(F.startswith("value", F.lit("\0"))).alias("led"), F.count_if(F.endswith("value", F.lit("\0"))).alias("trailed"),
        F.min_by("value", "place").alias("header"),
    )
    head = F.hex(F.substring(F.col("header").cast("binary"), 1, 2))
    little, big = WIDE
    status = F.when(head == WIDE[little], little).when(head == WIDE[big], big)
    # Without a mark: of n lines, all but the first begin with the other half of a line feed, or all but the last end with it.
    # The first has a whole number of characters before the line feed, or half a one more.
    wide = (F.col("n") > 1) & (2 * F.greatest("led", "trailed") >= F.col("n"))
    odd = F.octet_length("header") % 2 == 1
    status = status.when(wide & odd, big).when(wide, little)
    marked = (F.col("size") - F.col("in_lines")).between(2, 3)
    status = status.when(F.col("utf8"), F.when(marked, "utf-8-sig").otherwise("utf-8"))
    for i, charset in enumerate(charsets):
        status = status.when(F.col("bits").bitwiseAND(1 << i) != 0, charset)
    return known.select("file", status.otherwise(UNDECODABLE).alias("status"), F.col("header").cast("binary").alias("header"))


def _paths(status: DataFrame, charset: str) -> list[str]:
    """Files of one charset, as paths to read: as many as there are files of that kind."""
    found = status.filter(F.col("status") == charset).select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))))
    return [r[0] for r in found.collect()]


def _wide_lines(spark: SparkSession, status: DataFrame, charset: str) -> DataFrame | None:
    """(file, line, block, at) of files in a charset of two bytes; a line that is not valid is null."""
    paths = _paths(status, charset)
    if not paths:
        return None
    text = decode_lines(charset)(F.col("value").cast("binary"))
    first = (F.col("block") == 0) & F.startswith(text, F.lit(BOM))
    line = F.regexp_replace(F.when(first, F.substr(text, F.lit(2))).otherwise(text), "\r$", "")
    return raw_lines(spark, paths, charset=charset).select("file", line.alias("line"), "block", "at")


def file_status(
    spark: SparkSession,
    path: str,
    fallback: str | Sequence[str] = "cp949",
    glob: str | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """(file, status) for every file, as `file_profile` tells it; files of two bytes a character must also decode.

    Files of zero bytes have no lines: give `expected` (file, as full paths) to have those
    and files that are missing as `skipped`.
    """
    status = materialise(file_profile(spark, path, fallback, glob).select("file", "status"), "file-status")
    for charset in WIDE:
        lines = _wide_lines(spark, status, charset)
        if lines is not None:
            broken = lines.filter("line is null").select("file").distinct().withColumn("broken", F.lit(UNDECODABLE))
            known = status.join(broken, "file", "left").select("file", F.coalesce("broken", "status").alias("status"))
            status = materialise(known, "file-status")
    if expected is None:
        return status
    # Local paths are written with one slash or three.
    path = F.regexp_replace("file", "^file:/+", "/")
    wanted = expected.select("file", path.alias("path"))
    joined = wanted.join(status.select(path.alias("path"), "status"), "path", "left")
    return joined.select("file", F.coalesce("status", F.lit(SKIPPED)).alias("status"))


def recode_lines(
    spark: SparkSession, path: str, fallback: str | Sequence[str] = "cp949", glob: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(lines, status): all lines of readable files as text, and what became of each file.

    The charset of a file holds for all its lines, also for those that would be valid in another. A
    file with any undecodable byte is quarantined as a whole: it gives a status and no line. Lines have their
    `block` and their place `at` among the lines of a task, so a file can be put in order.
    """
    status = file_status(spark, path, fallback, glob)
    # One row per file: adaptive execution sees its size and picks how to join.
    narrow = status.filter(~F.col("status").isin(UNDECODABLE, *WIDE))
    lines = raw_lines(spark, path, glob).join(narrow, "file")
    text = F.when(F.startswith("status", F.lit("utf-8")) | _ascii(), F.col("value"))
    for charset in [fallback] if isinstance(fallback, str) else fallback:
        raw = F.when((F.col("status") == charset) & ~_ascii(), F.col("value").cast("binary"))
        text = text.when(F.col("status") == charset, decode_lines(charset, strict=True)(raw))
    kept = lines.select("file", "status", text.alias("line"), "block", "at")
    for charset in WIDE:
        wide = _wide_lines(spark, status, charset)
        if wide is not None:
            kept = kept.unionByName(wide.withColumn("status", F.lit(charset)))
    return kept, status


def write_recoded(lines: DataFrame, path: str, root: str | None = None) -> None:
    """Write lines of `recode_lines` as UTF-8 with BOM, into a folder for each source file.

    A folder `file=<name>` holds the file in parts, in order; the part with its beginning starts
    with the mark. The name is the path of the source file below `root`, or the whole path, with slashes escaped; so files of one
    name in two folders stay apart. Lines stay in the tasks that read them.
    """
    bare = "^[a-z0-9]+:(//[^/]*)?/+"
    name = F.regexp_replace("file", bare, "/")
    if root is not None:
        top = F.regexp_replace(F.lit(root.rstrip("/") + "/"), bare, "/")
        name = F.when(F.startswith(name, top), F.substr(name, F.length(top) + 1)).otherwise(name)
    ordered = lines.select(name.alias("name"), "block", "at", "line").sortWithinPartitions("name", "block", "at")

    def mark(batches):
        last = None
        for batch in batches:
            names, blocks, texts = (batch.column(k).to_pylist() for k in ("name", "block", "line"))
            for i, key in enumerate(zip(names, blocks)):
                if key != last and key[1] == 0:
                    texts[i] = BOM + texts[i]
                last = key
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("name")], ["value", "file"])

    ordered.mapInArrow(mark, "value string, file string").write.partitionBy("file").text(path)
