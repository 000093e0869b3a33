"""Threshold-scaled sketches of documents, in DataFrame operations only.

A sketch keeps every shingle hash below a fixed fraction of all hashes, so its size follows the
document and sketches of very unequal documents compare well: the share of the smaller sketch
that is in the larger estimates how much of the one text is in the other. Sketches of parts
merge to that of the whole by union. The least hash is kept in any case, so a text with a word
never has an empty sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .shared import WORD, with_rank

FRACTION = 1 / 4
SHINGLE = 5


def with_sketch(
    df: DataFrame, text: str, name: str, shingle: int = SHINGLE, fraction: float = FRACTION
) -> DataFrame:
    """Add the sketch of a text column; fewer than `shingle` words are one run, no word gives an empty sketch.

    Words, their hashes and the hashes of runs are columns one after the other, so each is made
    once; runs are hashed from the hashes of their words, so no text is put together again.
    """
    runs = F.transform(
        F.sequence(F.lit(0), F.size("_words") - shingle),
        lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(shingle)]),
    )
    few = F.when(F.size("_words") > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<bigint>"))
    return (
        df.withColumn("_texts", F.regexp_extract_all(F.col(text), F.lit(f"({WORD})")))
        .withColumn("_words", F.transform("_texts", lambda w: F.xxhash64(w)))
        .withColumn("_runs", F.when(F.size("_words") < shingle, few).otherwise(runs))
        .withColumn(name, sketch(F.col("_runs"), fraction))
        .drop("_texts", "_words", "_runs")
    )


def sketch(hashes: Column, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes among the lowest `fraction` of all 64-bit numbers, and the least one."""
    limit = int(-(2**63) + fraction * 2**64)
    low = F.filter(hashes, lambda h: h < limit)
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(low, F.array(F.array_min(hashes))))))


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    return sketch(F.concat(a, b), fraction)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the smaller shingle set that is in the other, 0 to 1.

    Two texts without a word are alike; one without is not like one with words.
    """
    smaller = F.least(F.size(a), F.size(b))
    both = F.greatest(F.size(a), F.size(b)) == 0
    share = F.size(F.array_intersect(a, b)) / F.nullif(smaller, F.lit(0))
    return F.when(both, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).cast("double")


def as_text(sketched: Column) -> Column:
    """16 lowercase hex digits for each hash, in order; empty for a text without words."""
    return F.lower(F.array_join(F.transform(sketched, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def fingerprint_pairs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, fraction: float = FRACTION
) -> DataFrame:
    """Each document's sketch beside those of its edited text and of the next document.

    Gives doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The edited text has its last half replaced by as many characters of the next document, in
    ascending doc_id order; the first follows the last. Null texts are empty. Rows that agree in id
    and text are one document in that order, and each gets a row; texts that share an id are
    ordered by hash; a null id comes first. A single document is next to itself. An empty table
    gives no rows. The order is found on ids alone, and what is shuffled of a text is itself and the
    half that its predecessor takes.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # A document's key: its id, and a hash of id and text that tells a missing id from 0.
    key = ["id", "hash"]
    rows = rows.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("hash"), "doc_id", "text")
    ids = rows.groupBy(*key, "doc_id").agg(F.first(F.length("text")).alias("n_chars"))
    ranked = with_rank(materialise(ids, "ids"), ["doc_id", "hash"], "rank")
    ranked = materialise(ranked, "ranked-ids")
    last = ranked.count() - 1
    # The document before takes a part of this one: as many characters as half of its own.
    before = F.when(F.col("rank") == 0, last).otherwise(F.col("rank") - 1)
    takers = ranked.select(
        F.col("rank").alias("taker"), F.col("id").alias("taker_id"), F.col("hash").alias("taker_hash"),
        F.col("doc_id").alias("taker_doc"), F.expr("n_chars div 2").alias("taken"),
    )
    given = ranked.select(*key, before.alias("taker")).join(takers, "taker").drop("taker")
    given = materialise(given, "given")
    # Both joins by key use one exchange of the texts: they read the same columns.
    rows = rows.drop("doc_id")
    heads = with_sketch(rows.join(given, key), "text", "next_sketch", shingle, fraction).select(
        F.col("taker_id").alias("id"), F.col("taker_hash").alias("hash"),
        F.struct(F.expr("substring(text, 1, int(taken))").alias("head"), "next_sketch", F.col("taker_doc").alias("doc_id")).alias("next"),
    )
    heads = heads.groupBy(*key).agg(F.first("next").alias("next"))
    kept = F.expr("substring(text, 1, int(length(text) - length(text) div 2))")
    paired = rows.join(heads, key).select(
        F.col("next.doc_id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"), "text",
        F.concat(kept, F.col("next.head")).alias("edited"), F.col("next.next_sketch").alias("next_sketch"),
    )
    paired = with_sketch(with_sketch(paired, "text", "sketch", shingle, fraction), "edited", "edited_sketch", shingle, fraction)
    return paired.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
