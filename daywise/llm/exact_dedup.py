"""Exact dedup by polynomial fingerprints that are put together from pieces.

A text is a number in a large base, one digit a byte, taken modulo two primes. The hash of a text
is that of its left part, shifted by the length of the right one, plus that of the right: pieces are hashed apart, each is
shifted by the bytes after it, and the sum is the fingerprint. So a huge document is hashed by many tasks. Texts
of equal fingerprint are compared piece by piece before they count as equal.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

# Bytes of a piece. Texts of more than one piece are dealt out.
PIECE = 1 << 16
# The two largest primes below 2**31, so that sums of a piece's products fit in 64 bits, and a base for each.
MODULI = (2147483647, 2147483629)
BASES = (1103515245, 1664525013)

FINGERPRINT = ["n_bytes", "f1", "f2"]


@functools.cache
def _powers(base: int, modulus: int, n: int) -> np.ndarray:
    """base ** (n - 1), ..., base, 1 modulo `modulus`."""
    powers = np.ones(1, np.uint64)
    while len(powers) < n:
        powers = np.concatenate((powers, powers * np.uint64(pow(base, len(powers), modulus)) % np.uint64(modulus)))
    return np.ascontiguousarray(powers[:n][::-1])


def hash_piece(data: bytes, moduli: tuple[int, ...] = MODULI, size: int = PIECE) -> tuple[int, ...]:
    """The hash of at most `size` bytes modulo each prime."""
    digits = np.frombuffer(data, np.uint8).astype(np.uint64)
    return tuple(int(digits @ _powers(b, m, size)[size - len(digits) :]) % m for b, m in zip(BASES, moduli))


def shifted(hashes: tuple[int, ...], after: int, moduli: tuple[int, ...] = MODULI) -> tuple[int, ...]:
    """What a piece adds to the fingerprint of a text that goes on for `after` bytes."""
    return tuple(h * pow(b, after, m) % m for h, b, m in zip(hashes, BASES, moduli))


def fingerprint(data: bytes, moduli: tuple[int, ...] = MODULI, size: int = PIECE) -> tuple[int, ...]:
    """(bytes, hash, hash) of a whole text, summed over its pieces."""
    total = (0,) * len(moduli)
    for i in range(0, len(data), size):
        piece = data[i : i + size]
        part = shifted(hash_piece(piece, moduli, size), len(data) - i - len(piece), moduli)
        total = tuple((a + b) % m for a, b, m in zip(total, part, moduli))
    return len(data), *total


def _rows(columns: list[list], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, bytes): rows with the hash that finds a text again."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("binary").alias("bytes")
    )


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", moduli: tuple[int, ...] = MODULI, size: int = PIECE
) -> DataFrame:
    """(row, doc_id, text_hash, text_sha256, n_bytes, f1, f2) of every row's text, A to Z in lower case.

    One scan. Texts of one piece are hashed where they are read; those of more are dealt out by piece, hashed
    wherever a piece lands, and summed. Only these texts are shuffled.
    """

    def cut(batches):
        names = ["row", "doc_id", "text_hash", "sha256", "n_bytes", "after", "h1", "h2", "piece"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for start in range(0, len(batch), 256):
                out: list[list] = [[] for _ in names]
                few = batch.slice(start, 256)
                for row, name, text_hash, raw in zip(*(few.column(c).to_pylist() for c in ("row", "doc_id", "text_hash", "bytes"))):
                    data = (raw or b"").lower()
                    digest = hashlib.sha256(data).digest()
                    for i in range(0, max(len(data), 1), size):
                        piece = data[i : i + size]
                        whole = len(data) <= size
                        hashes = hash_piece(piece, moduli, size) if whole else (None, None)
                        values = (row, name, text_hash, digest, len(piece), len(data) - i - len(piece), *hashes, None if whole else piece)
                        for column, value in zip(out, values):
                            column.append(value)
                yield _rows(out, names, kinds)

    def hash_dealt(batches):
        names = ["row", "doc_id", "text_hash", "sha256", "n_bytes", "h1", "h2"]
        for batch in batches:
            for start in range(0, len(batch), 256):
                few = batch.slice(start, 256)
                h1, h2 = few.column("h1").to_pylist(), few.column("h2").to_pylist()
                dealt = few.column("piece")
                for k in np.flatnonzero(dealt.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    h1[k], h2[k] = shifted(hash_piece(dealt[k].as_py(), moduli, size), few.column("after")[k].as_py(), moduli)
                yield pa.RecordBatch.from_arrays([*(few.column(c) for c in names[:5]), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names)

    common = "row long, doc_id long, text_hash long, sha256 binary, n_bytes long"
    numbered = _keyed(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id())
    pieces = numbered.mapInArrow(cut, f"{common}, after long, h1 long, h2 long, piece binary")
    hashed = pieces.repartition("row", "after").mapInArrow(hash_dealt, f"{common}, h1 long, h2 long")
    summed = hashed.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("sha256").alias("sha256"),
        F.sum("n_bytes").alias("n_bytes"), *[(F.sum(h) % m).alias(f) for h, m, f in zip(("h1", "h2"), moduli, ("f1", "f2"))],
    )
    return summed.select("row", "doc_id", "text_hash", F.lower(F.hex("sha256")).alias("text_sha256"), *FINGERPRINT)


def _groups(rows: DataFrame, by: list[str]) -> DataFrame:
    """Size of each group, and the row that stays: of the largest id, then the first that was read."""
    return (
        rows.groupBy(*by)
        .agg(F.max(F.struct("doc_id", (-F.col("row")).alias("row"))).alias("keep"), F.count("*").alias("group_size"))
        .select(*by, F.col("keep.doc_id").alias("keep_id"), (-F.col("keep.row")).alias("keep_row"), "group_size")
    )


def _told(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    single = F.col("group_size").isNull()
    return rows.join(groups, by, "left").select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256", "text_hash",
    )


def equal_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", moduli: tuple[int, ...] = MODULI, size: int = PIECE
) -> DataFrame:
    """A row for each row: doc_id, keep_id, group_size, kept, text_sha256, text_hash.

    Texts are equal if they are the same after lower-casing A to Z; null is empty, and empty texts are equal. Of
    equal texts the row with the largest id stays; a null id is below all others, and of rows that share the
    largest id one stays. An empty table gives no rows; other columns are not looked at.

    Whole texts are shuffled once, to those of their fingerprint's group that repeat, and compared there: of each place of a
    group the least and the greatest piece are kept, which combines before the shuffle, so a group of any size sends at most two
    pieces a place and task. If they differ anywhere, texts of that fingerprint are grouped by what they are.
    """
    rows = materialise(fingerprints(docs, doc_id, text, moduli, size), "fingerprints")
    groups = materialise(_groups(rows, FINGERPRINT).filter("group_size > 1"), "groups")
    members = rows.join(groups.select(*FINGERPRINT), FINGERPRINT, "left_semi")
    keys = materialise(members.select("doc_id", "text_hash", *FINGERPRINT).distinct(), "members")
    same = _same_key("doc_id", "text_hash")
    whole = _keyed(docs, doc_id, text).join(keys.toDF("_id", "_hash", *FINGERPRINT).hint("shuffle_hash"), same)

    def cut(batches):
        names = [*FINGERPRINT, "at", "piece"]
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            for start in range(0, len(batch), 256):
                out: list[list] = [[] for _ in names]
                few = batch.slice(start, 256)
                for *known, raw in zip(*(few.column(c).to_pylist() for c in (*FINGERPRINT, "bytes"))):
                    data = (raw or b"").lower()
                    # Rows found by a hash that is not theirs belong to another fingerprint.
                    if fingerprint(data, moduli, size) == tuple(known):
                        for i in range(0, len(data), size):
                            for column, value in zip(out, (*known, i, data[i : i + size])):
                                column.append(value)
                yield _rows(out, names, kinds)

    pieces = whole.select(*FINGERPRINT, "bytes").mapInArrow(cut, "n_bytes long, f1 long, f2 long, at long, piece binary")
    ends = pieces.groupBy(*FINGERPRINT, "at").agg(F.min("piece").alias("least"), F.max("piece").alias("greatest"))
    unequal = materialise(ends.filter("least <> greatest").select(*FINGERPRINT).distinct(), "unequal")
    if unequal.isEmpty():
        return _told(rows, groups, FINGERPRINT)
    # Other texts under one fingerprint: rows of such are told apart by the text itself.
    sound = _told(rows.join(unequal, FINGERPRINT, "left_anti"), groups, FINGERPRINT)
    normal = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    doubted = keys.join(unequal, FINGERPRINT, "left_semi").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    again = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), normal.alias("normal"))
    again = again.join(doubted, same, "left_semi").withColumn("row", F.monotonically_increasing_id())
    again = again.withColumn("text_sha256", F.sha2("normal", 256))
    again = materialise(again, "doubted")
    return sound.unionByName(_told(again, _groups(again, ["normal"]), ["normal"]))


def _same_key(doc_id: str, text_hash: str) -> Column:
    return F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col(text_hash) == F.col("_hash"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows alike in id and text any one."""
    kept = equal_texts(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    kept = materialise(kept.distinct(), "kept")
    keyed = docs.withColumns({"_row_id": F.col(doc_id).cast("long"), "_row_hash": F.xxhash64(text)})
    return keyed.join(kept, _same_key("_row_id", "_row_hash"), "left_semi").dropDuplicates(["_row_id", "_row_hash"]).drop("_row_id", "_row_hash")
