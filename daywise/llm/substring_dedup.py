"""Substring dedup by sliding spans of sentences.

Texts are cut into sentences, and long sentences into pieces by what their words are, wherever they stand.
At every piece of every document a span begins and one ends: as few pieces as there are in a run of at
least `MIN_SENTENCES` and `MIN_WORDS` words. A shorter document is one span. Spans are hashed and brought together over all documents; of equal
spans the first stays, and pieces that any other covers are removed.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

MIN_SENTENCES = 2
MIN_WORDS = 20
# In a sentence, every window of so many words is cut after its word of least hash: no piece is longer, and
# two texts that share a passage are cut alike in it but for so many words at either end.
WINDOW = 12

_END = re.compile(r"(?<=[.!?])[\"'»”)\]]*\s+|(?<=[。！？｡])[\"'»”’）」』\])]*\s*|\s*\n\s*")
# Scripts without white space between words: each character counts as a word.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u312f\u31a0-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words))


def _classes() -> np.ndarray:
    """What each code point is to `_words`; the last entry stands for all from there on."""
    table = np.zeros(0x10000, np.uint8)
    table[[i for i in range(0x10000) if chr(i).isspace()]] = _SPACE
    table[[ord(c) for c in ".!?"]] = _MARK
    table[[ord(c) for c in "\"'»”)]"]] = _CLOSER
    table[[i for i in range(0x10000) if _UNSPACED_MARK.match(chr(i))]] = _ALONE
    table[0xFFFF] = _ALONE
    return table


_SPACE, _MARK, _CLOSER, _ALONE = 1, 2, 3, 4
_UNSPACED_MARK = re.compile(f"[{_UNSPACED}]")
_CLASS = _classes()


def _least_in_windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each window of `size` hashes, the place of its least, the first of equals."""
    least = hashes.astype(np.uint64) << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width < size:
        step = min(width, size - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _words(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words, where each begins, and the numbers of those that a sentence ends before."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = _CLASS[np.minimum(points, 0xFFFF)]
    if (classes == _ALONE).any():
        # Words need no white space between them.
        found = list(_WORD.finditer(text))
        starts = np.fromiter((m.start() for m in found), np.int64, len(found))
        ends = np.searchsorted(starts, np.fromiter((m.end() for m in _END.finditer(text)), np.int64))
        return [m[0] for m in found], starts, ends
    blank = np.concatenate(([True], classes == _SPACE, [True]))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    stops = np.flatnonzero(~blank[:-1] & blank[1:])
    # The last character of a word that closes nothing; a word of closing marks alone ends no sentence.
    last = stops - 1
    while True:
        closing = (classes[last] == _CLOSER) & (last > starts)
        if not closing.any():
            break
        last = last - closing
    feeds = np.concatenate(([0], np.cumsum(points == 10)))
    ended = classes[last[:-1]] == _MARK
    ended |= feeds[starts[1:]] > feeds[stops[:-1]]
    return text.split(), starts, np.flatnonzero(ended) + 1


def _pieces(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words; the number of words before each piece and in all; the place in the text where each piece begins, and its end.

    Pieces end where sentences do, and in longer sentences at the words that their windows choose.
    """
    words, starts, ends = _words(text)
    if not words:
        whole = [0, len(text)] if text else [0]
        return words, np.zeros(len(whole), np.int64), np.array(whole)
    cuts = np.zeros(len(words) + 1, bool)
    cuts[ends] = True
    if len(words) >= WINDOW:
        sentence = np.cumsum(cuts[:-1])
        inside = sentence[: len(words) - WINDOW + 1] == sentence[WINDOW - 1 :]
        cuts[_least_in_windows(_word_hashes(words), WINDOW)[inside] + 1] = True
    cuts[[0, -1]] = True
    before = np.flatnonzero(cuts)
    return words, before, np.array([0, *starts[before[1:-1]], len(text)])


def sentences(text: str) -> list[tuple[int, int]]:
    """[start, end) of each sentence or piece of one with the white space after it; together they are the whole text."""
    bounds = _pieces(text)[2].tolist()
    return list(zip(bounds, bounds[1:]))


def _spans(text: str, min_sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray, list[bytes], int]:
    """First piece, pieces and hash of the shortest spans that begin and that end at each piece; and the number of pieces.

    With those that end, the last pieces of a repeat are in a span that lies inside it. A text that
    is shorter than any span is one. Only words are hashed, so it does not matter how a span is cut inside.
    """
    told, words, _ = _pieces(text)
    if not told:
        return words[:0], words[:0], [], len(words) - 1
    line = " ".join(told).encode()
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], spaces + 1, [len(line) + 1]))[words]
    at, end = np.arange(len(words)), len(words) - 1
    last = np.searchsorted(words, words + min_words)
    first = np.searchsorted(words, words - min_words, "right") - 1
    if min_sentences > 1:
        # A piece of enough words is a span by itself.
        least = np.where(np.diff(words) >= min_words, 1, min_sentences)
        last[:-1] = np.maximum(last[:-1], at[:-1] + least)
        first[1:] = np.minimum(first[1:], at[1:] - least)
    both = np.concatenate(((at * len(words) + last)[last <= end], (first * len(words) + at)[first >= 0]))
    begins, ends = np.divmod(np.unique(both) if len(both) else np.array([end]), len(words))
    hashed = xxhash.xxh3_128_digest
    digests = [hashed(line[a:b]) for a, b in zip(starts[begins].tolist(), (starts[ends] - 1).tolist())]
    return begins, ends - begins, digests, end


KEY = ["doc_id", "text_hash"]
# Rows of one text made at once from a count.
_BLOCK = 1_000_000


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, text): rows that agree in id and text are one document."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))


def _spans_and_sizes(rows: DataFrame, min_sentences: int, min_words: int) -> DataFrame:
    """(doc_id, text_hash, at, n, hash, more) of every span, and a row for each document with its pieces as `at` and n = 0."""

    def spans(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                few = batch.slice(start, 512)
                numbers, places, counts, hashes = [], [], [], []
                for k, whole in enumerate(few.column("text").to_pylist()):
                    at, n, digests, pieces = _spans(whole or "", min_sentences, min_words)
                    numbers.extend([k] * (len(at) + 1))
                    places += [at, [pieces]]
                    counts += [n, [0]]
                    hashes += [*digests, bytes(16)]
                both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                columns = [few.column(c).take(pa.array(numbers, pa.int64())) for c in KEY]
                columns += [pa.array(np.concatenate(c).astype(np.int32)) for c in (places, counts)]
                columns += [pa.array(np.ascontiguousarray(both[:, k])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, [*KEY, "at", "n", "hash", "more"])

    return rows.mapInArrow(spans, "doc_id long, text_hash long, at int, n int, hash long, more long")


def _repeats(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, n) of every span that is not the first of its kind, by document and place.

    Spans meet by hash. Half of it is counted first, combined before the shuffle, so that only spans that
    may repeat are looked at further; then comes the least place of each hash, and a join of those spans with
    it. Adaptive execution splits a hot span in both joins. A null id is before all others; texts that share an id are in the
    order of their hash.
    """
    found = found.filter("n > 0")
    # Written, so that the joins read what repeats from an exchange of its own and a hot span can be split.
    several = materialise(found.groupBy("hash").count().filter("count > 1").select("hash"), "several")
    found = materialise(found.join(several, "hash"), "candidates")
    place = F.struct(*KEY, "at")
    again = found.groupBy("hash", "more").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    again = materialise(again.select("hash", "more", "first"), "repeated")
    later = found.join(again, ["hash", "more"]).filter(place != F.col("first"))
    return later.select(*KEY, "at", "n")


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, text_hash, at, n) of every span that is not the first of its kind, by id, hash of the text, and place."""
    found = _spans_and_sizes(_rows(docs, doc_id, text), min_sentences, min_words)
    return _repeats(materialise(found, "spans"))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS
) -> DataFrame:
    """A row for each row: doc_id, text without covered sentences, n_sentences, n_removed, changed.

    Whole texts are searched. Sentences end at `.`, `!`, `?` before white space, at ideographic marks and at
    line feeds; sentences of `WINDOW` words or more are cut into pieces at words chosen by their hash, and
    each piece counts as one of `n_sentences`. So a repeat that begins or ends inside a sentence is removed
    but for under `WINDOW` words at the beginning and at most as many at the end; one of
    2 x `WINDOW` + `min_words` words is always found. White space does not tell spans apart. The first span in order of doc_id and place stays. Null texts
    stay null; texts that share an id are told apart by their hash, and only what repeats is cut from each. Rows that agree in id and text are
    copies: one is cut like any other, the others end up empty, as does any document that is a copy throughout. An empty table gives no
    rows; other columns are not looked at. Only texts with something to cut are cut into sentences a second time.
    """
    rows = _rows(docs, doc_id, text)
    found = materialise(_spans_and_sizes(rows, min_sentences, min_words), "spans")
    # Spans of one document only: as many as it has sentences at most.
    covered = _repeats(found).groupBy(*KEY).agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    sizes = found.filter("n = 0").groupBy(*KEY).agg(F.max("at").alias("pieces"), F.count("*").alias("copies"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    told = sizes.join(covered.toDF("_id", "_hash", "spans"), same, "left").select(*KEY, "pieces", "copies", "spans")
    told = materialise(told, "told")
    known = told.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "pieces", "copies", "spans")

    def cut(batches):
        names = ["doc_id", "text_hash", "copies", "text", "n_sentences", "n_removed", "changed"]
        for batch in batches:
            for start in range(0, len(batch), 512):
                few = batch.slice(start, 512)
                texts, spans = few.column("text"), few.column("spans")
                removed = np.zeros(len(few), np.int32)
                held = np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False))
                if len(held):
                    whole = texts.to_pylist()
                    for k in held.tolist():
                        whole[k], removed[k] = _without(whole[k] or "", spans[k].as_py())
                    texts = pa.array(whole, pa.string())
                columns = [few.column("doc_id"), few.column("text_hash"), few.column("copies"), texts, few.column("pieces"), pa.array(removed), pa.array(removed > 0)]
                yield pa.RecordBatch.from_arrays(columns, names)

    joined = rows.join(known, same).select(*KEY, "text", "pieces", "copies", "spans")
    kinds = "doc_id long, text_hash long, copies long, text string, n_sentences int, n_removed int, changed boolean"
    out = ["doc_id", "text", "n_sentences", "n_removed", "changed"]
    # A null text is a document of no words, and stays.
    several = told.filter("copies > 1 and pieces > 0")
    cut_rows = joined.mapInArrow(cut, kinds)
    if several.isEmpty():
        return cut_rows.select(out)
    copied = joined.filter("copies > 1 and pieces > 0").mapInArrow(cut, kinds)
    first = copied.groupBy(*KEY).agg(F.first(F.struct("text", "n_sentences", "n_removed", "changed")).alias("r")).select("doc_id", "r.*")
    blocks = F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 2) div {_BLOCK}"))).alias("block")
    others = several.select("doc_id", "pieces", "copies", blocks)
    size = F.least(F.lit(_BLOCK), F.col("copies") - 1 - F.col("block") * _BLOCK)
    others = others.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(
        "doc_id", F.lit("").alias("text"), F.col("pieces").alias("n_sentences"), F.col("pieces").alias("n_removed"), F.lit(True).alias("changed")
    )
    single = joined.filter("copies = 1 or pieces = 0").mapInArrow(cut, kinds).select(out)
    return single.unionByName(first).unionByName(others)


def _without(text: str, spans: list[dict]) -> tuple[str, int]:
    """The text without the pieces that the spans cover, and how many these are."""
    bounds = _pieces(text)[2]
    gone = np.zeros(len(bounds), np.int64)
    for span in spans:
        gone[span["at"]] += 1
        gone[span["at"] + span["n"]] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    # Runs of pieces that stay.
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True]))))
    kept = "".join(text[a:b] for a, b in bounds[edges].reshape(-1, 2).tolist())
    return kept, int(gone.sum())
