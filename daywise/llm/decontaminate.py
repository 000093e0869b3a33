"""Benchmark decontamination with spaced seeds.

A seed looks at a window of words through a fixed mask that leaves some positions out, so a
changed word at such a position does not hide a match. Every window of every document is hashed
under each mask and joined with the hashes of the benchmark; around each hit the two texts are then laid side by
side without gaps and compared word by word, where some words may differ.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .substring_dedup import _UNSPACED as UNSPACED

# 1: the word counts; 0: any word fits. All begin and end in 1. Wherever two of ten words differ, one of these fits
# somewhere among the others.
MASKS = ("111011", "11010011", "11111")
SIMILARITY = 0.8
# Words that an overlap must have; an item of fewer must be there whole.
LEAST_WORDS = 10
# Bits of the table that tells which hashes a benchmark may have; 4 MB, whatever its size.
FILTER_BITS = 25
# Characters of scripts without white space are words of their own.
WORDS = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words: runs of letters, digits and underscores, lower-cased."""
    words = WORDS.findall(text.lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the window at each position, under one mask."""
    n = len(words) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    mixed = np.full(n, int(mask, 2), np.uint64)
    for i in (i for i, c in enumerate(mask) if c == "1"):
        mixed = (mixed ^ words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << FILTER_BITS) - 1)
    return hashes & low, (hashes >> np.uint64(64 - FILTER_BITS)) & low


def _seen(filter_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _slots(hashes)

    def there(slots):
        return (filter_bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1

    found = there(a).astype(bool)
    found[found] = there(b[found]).astype(bool)
    return found


def benchmark_words(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """item_id, words (array of hashes) of each item that has a word."""

    def hashed(batches):
        for batch in batches:
            words = [word_hashes(x.as_py() or "").view(np.int64) for x in batch.column("text")]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(words, kind)], ["item_id", "words"])

    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(hashed, "item_id long, words array<bigint>").filter(F.size("words") > 0)


def _benchmark_seeds(items: DataFrame, masks: tuple[str, ...], least_words: int) -> DataFrame:
    """(item_id, item_at, seed): of short items all words at once, of others the windows under each mask."""

    def seeds(batches):
        for batch in batches:
            ids, at, found = [], [], []
            for item, words in zip(batch.column("item_id"), batch.column("words")):
                row = np.array(words.values, np.int64).view(np.uint64)
                for mask in masks if len(row) >= least_words else ("1" * len(row),):
                    hashes = seed_hashes(row, mask)
                    ids.extend([item.as_py()] * len(hashes))
                    at.extend(range(len(hashes)))
                    found.extend(hashes.view(np.int64).tolist())
            columns = [pa.array(ids, pa.int64()), pa.array(at, pa.int32()), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "item_at", "seed"])

    return items.mapInArrow(seeds, "item_id long, item_at int, seed long")


def _filter_of(seeds: DataFrame) -> np.ndarray:
    """The bitmap of all benchmark seeds. Tasks set bits; the driver gets each set byte once."""

    def slots(batches):
        for batch in batches:
            a, b = _slots(np.array(batch.column("seed"), np.int64).view(np.uint64))
            both = np.unique(np.concatenate((a, b)))
            bits = (1 << (both & np.uint64(7)).astype(np.int64)).astype(np.int32)
            columns = [pa.array((both >> np.uint64(3)).astype(np.int32)), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(columns, ["at", "bits"])

    bitmap = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    merged = seeds.select("seed").mapInArrow(slots, "at int, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    found = merged.toArrow()
    bitmap[found["at"].to_numpy()] = found["bits"].to_numpy()
    return bitmap


def _stretches(docs: DataFrame, doc_id: str, text: str, bitmap, masks: tuple[str, ...], reach: int) -> DataFrame:
    """Stretches of documents with hits: their words, and each hit's seed and place in the stretch.

    `reach` words are kept on both sides of a hit: as many as the longest item has.
    """
    span = max(map(len, masks))

    def scan(batches):
        for batch in batches:
            out = ([], [], [], [], [])
            for name, whole in zip(batch.column("doc_id"), batch.column("text")):
                words = word_hashes(whole.as_py() or "")
                at, found = [], []
                for mask in masks:
                    hashes = seed_hashes(words, mask)
                    hits = np.flatnonzero(_seen(bitmap.value, hashes))
                    at.append(hits)
                    found.append(hashes[hits])
                at, found = np.concatenate(at), np.concatenate(found)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, found = at[order], found[order]
                for few in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > reach) + 1):
                    first = max(0, int(at[few[0]]) - reach)
                    part = words[first : int(at[few[-1]]) + span + reach]
                    row = (name.as_py(), first, part.view(np.int64), (at[few] - first).astype(np.int32), found[few].view(np.int64))
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "first", "words", "at", "seeds"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, first long, words array<bigint>, at array<int>, seeds array<bigint>"
    return rows.mapInArrow(scan, schema)


def _compare(similarity: float, least_words: int):
    """Longest side-by-side overlap of each pair where enough words are equal."""

    def best(equal: np.ndarray) -> tuple[int, int, int]:
        """(words, equal words, first) of the longest run with a share of equal words; its ends are equal."""
        # A run (i, j] has a share of at least s where sum(equal - s) >= 0: find the widest such pair.
        gain = np.concatenate(([0.0], np.cumsum(equal - similarity))) + 1e-9 * np.arange(len(equal) + 1)
        lows = np.minimum.accumulate(gain)
        reach = np.searchsorted(-lows, -gain, side="left")
        widths = np.arange(len(gain)) - reach
        end = int(np.argmax(widths))
        start = int(reach[end])
        return end - start, int(equal[start:end].sum()), start

    def compare(batches):
        for batch in batches:
            columns = {k: batch.column(k) for k in batch.schema.names}
            rows = []
            for i in range(len(batch)):
                words = np.array(columns["words"][i].values, np.int64)
                item = np.array(columns["item_words"][i].values, np.int64)
                shift = columns["shift"][i].as_py()
                # `words` are those beside the item, from the first of the stretch on.
                at = max(0, -shift)
                m = min(len(words), len(item) - at)
                length, equal, start = best(words[:m] == item[at : at + m])
                short = len(item) < least_words
                if equal == len(item) if short else length >= least_words:
                    begin = columns["first"][i].as_py() + max(0, shift) + start
                    rows.append((columns["doc_id"][i].as_py(), columns["item_id"][i].as_py(), length, equal, begin))
            out = list(zip(*rows)) if rows else [()] * 5
            names = ["doc_id", "item_id", "overlap_words", "equal_words", "first_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    return compare


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", masks: tuple[str, ...] = MASKS, similarity: float = SIMILARITY,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """A row for each document and benchmark item that overlap: doc_id, item_id, overlap_words, equal_words, first_word.

    An overlap is a stretch of `least_words` words or more, side by side in both, of which a share
    of `similarity` is equal; the longest counts. Found are those that agree with a seed somewhere:
    all of ten words, nearly all of more (any stretch of ten words with two or fewer that differ has a seed). An item of under `least_words` words
    overlaps where all of its words stand in a row, even if it is one word: filter by `overlap_words` where
    that says too little. Documents are read whole and once. Tasks pass on windows whose hash may be a
    benchmark's by a bitmap of fixed size; an exact join decides, and beside an item come only the words that it
    can cover. Null and empty texts, and items without a word, match nothing. Repeated documents and items give one row for each pair of
    ids; a document without an id is reported as null, an item without one is not used. Other columns are not looked at.
    """
    spark = docs.sparkSession
    items = materialise(benchmark_words(benchmark, item_id, item_text), "items")
    lengths = F.array_sort(F.collect_set(F.when(F.size("words") < least_words, F.size("words"))))
    longest, short = items.agg(F.max(F.size("words")), lengths).first()
    seeds = materialise(_benchmark_seeds(items, masks, least_words), "seeds")
    bitmap = spark.sparkContext.broadcast(_filter_of(seeds))
    windows = tuple(dict.fromkeys([*masks, *("1" * n for n in short)]))
    stretches = _stretches(docs, doc_id, text, bitmap, windows, longest or 0)
    stretches = stretches.withColumn("stretch", F.xxhash64("doc_id", "first", "words"))
    stretches = materialise(stretches, "stretches")
    hits = stretches.select("stretch", F.explode(F.arrays_zip("at", "seeds")).alias("hit"))
    hits = hits.select("stretch", F.col("hit.at").alias("at"), F.col("hit.seeds").alias("seed"))
    met = hits.join(seeds, "seed").select("stretch", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    sized = items.withColumnRenamed("words", "item_words").dropDuplicates(["item_id", "item_words"])
    met = met.join(sized.select("item_id", F.size("item_words").alias("n")).groupBy("item_id").agg(F.max("n").alias("n")), "item_id")
    begin = F.greatest("shift", F.lit(0))
    beside = F.slice("words", begin + 1, F.greatest(F.col("shift") + F.col("n") - begin, F.lit(0)))
    whole = stretches.select("stretch", "doc_id", "first", "words").dropDuplicates(["stretch"])
    laid = met.join(whole, "stretch").select("doc_id", "first", "item_id", "shift", beside.alias("words"))
    kept = laid.join(sized, "item_id").select("doc_id", "first", "words", "item_id", "item_words", "shift")
    schema = "doc_id long, item_id long, overlap_words long, equal_words long, first_word long"
    found = kept.mapInArrow(_compare(similarity, least_words), schema)
    longest = F.max(F.struct("overlap_words", "equal_words", (-F.col("first_word")).alias("back"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(longest).select(
        "doc_id", "item_id", "best.overlap_words", "best.equal_words", (-F.col("best.back")).alias("first_word")
    )
