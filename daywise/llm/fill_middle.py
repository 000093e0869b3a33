"""Fill-in-the-middle: texts are cut in three and put together in another order, between marks.

The characters of a text are put into four classes, and a wavelet matrix over the classes counts those of
a class before any place. A unit (line, sentence, word) ends at the characters of some classes, so the units that end
before a place are a sum of such ranks, and a cut after a number of units is found by bisection.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

OTHER, BLANK, FEED, STOP = range(4)
# The classes whose characters end a unit.
UNITS = {"line": (FEED,), "sentence": (FEED, STOP), "word": (FEED, BLANK), "character": (OTHER, BLANK, FEED, STOP)}
# Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
FORMS = ("plain", "psm", "spm")

# The last entry stands for all code points from there on.
_CLASS = np.zeros(0x3004, np.uint8)
_CLASS[[ord(c) for c in " \t"]] = BLANK
_CLASS[ord("\n")] = FEED
_CLASS[[ord(c) for c in ".!?。"]] = STOP

_BLOCK = 64


class Bits:
    """A bit vector that counts its ones before a place: packed, with a running count for every 512 bits."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.packbits(bits).tobytes()
        counts = np.bitwise_count(np.frombuffer(self.packed, np.uint8))
        self.before = np.concatenate(([0], np.cumsum(np.add.reduceat(counts, np.arange(0, len(counts), _BLOCK), dtype=np.int64)))) if len(counts) else np.zeros(1, np.int64)

    def rank(self, i: int) -> int:
        byte, rest = divmod(i, 8)
        block = byte // _BLOCK
        ones = int(self.before[block]) + int.from_bytes(self.packed[block * _BLOCK : byte]).bit_count()
        return ones + (self.packed[byte] >> (8 - rest)).bit_count() if rest else ones


class WaveletMatrix:
    """Ranks in a sequence of small numbers: a bit vector for each binary digit, the highest first.

    After each digit the sequence is reordered, zeros before ones, each in their old order.
    """

    def __init__(self, codes: np.ndarray, digits: int = 2):
        self.size, self.levels = len(codes), []
        for digit in reversed(range(digits)):
            bits = (codes >> digit) & 1
            codes = np.concatenate((codes[bits == 0], codes[bits == 1]))
            self.levels.append((digit, Bits(bits), self.size - int(bits.sum())))

    def rank(self, code: int, i: int) -> int:
        """How often `code` occurs before place `i`."""
        start = 0
        for digit, bits, zeros in self.levels:
            if code >> digit & 1:
                start, i = zeros + bits.rank(start), zeros + bits.rank(i)
            else:
                start, i = start - bits.rank(start), i - bits.rank(i)
        return i - start


class Cutter:
    """Units of one text and the places where they end."""

    def __init__(self, text: str, unit: str = "line"):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        classes = _CLASS[np.minimum(points, len(_CLASS) - 1)]
        self.ends, self.matrix, self.size = UNITS[unit], WaveletMatrix(classes), len(classes)
        open_end = self.size > 0 and int(classes[-1]) not in self.ends
        self.units = self.ended(self.size) + open_end

    def ended(self, i: int) -> int:
        """Units that end before place `i`: the ranks of the classes that end them, together."""
        return sum(self.matrix.rank(code, i) for code in self.ends)

    def after(self, k: int) -> int:
        """Where the first `k` units end: the least place before which so many ended."""
        if k >= self.units:
            return self.size
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            if self.ended(middle) >= k:
                high = middle
            else:
                low = middle + 1
        return low


def check_marks(marks: Sequence[str]) -> None:
    """Marks can be found again in an output only if none begins in or holds another."""
    for a in marks:
        for b in marks:
            inside = a is not b and a in b
            overlap = any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b) + (a is not b))))
            if not a or inside or overlap:
                raise ValueError(f"marks {a!r} and {b!r} cannot be told apart")


def _formatted(text: str, name: str, unit: str, seed: int, rate: int, spm: int, marks: Sequence[str]) -> tuple:
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    draws = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    cutter = Cutter(text, unit)
    n = cutter.units
    if not text or draws[2] % 100 >= rate or any(mark in text for mark in marks):
        return n, "plain", None, None, text
    first, second = sorted(draw % (n + 1) for draw in draws[:2])
    a, b = cutter.after(first), cutter.after(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if draws[3] % 100 < spm:
        return n, "spm", a, b - a, "".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a, b - a, "".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "line", seed: int = 7, rate: int = 100, spm: int = 50,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """A row for each row: doc_id, n (units), form, prefix_chars, middle_chars, output.

    Of 100 texts `rate` are cut, and of these `spm` have the suffix first; both cuts and both choices come from a
    hash of `seed` and the id, so a row always has the same output. Units are `line`, `sentence` (up to
    a line feed or any of `.!?。`), `word` (up to a blank, tab or line feed) or `character`; prefix and middle are whole
    units and may be empty. A text that is empty or holds a mark is `plain`: the output is the text,
    and both lengths are null. Null texts are empty, a null id is an empty one, rows that share an id are cut by the
    same draws. An empty table gives no rows; other columns are not looked at. Nothing is shuffled, and a task holds
    64 texts at a time.
    """
    check_marks(marks)
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {list(UNITS)}")

    def put(batches):
        for batch in batches:
            for start in range(0, len(batch), 64):
                few = batch.slice(start, 64)
                rows = zip(few.column("text").to_pylist(), few.column("name").to_pylist())
                made = [_formatted(t or "", name or "", unit, seed, rate, spm, marks) for t, name in rows]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_id).cast("string").alias("name"), F.col(text).alias("text"))
    return rows.mapInArrow(put, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form", marks: Sequence[str] = MARKS) -> Column:
    """The text an output was made of: what follows each mark, in the order of the text."""
    p, s, m = (F.lit(mark) for mark in marks)

    def between(mark: Column, until: Column) -> Column:
        return F.split_part(F.split_part(F.col(output), mark, F.lit(2)), until, F.lit(1))

    middle = F.split_part(F.col(output), m, F.lit(2))
    return (
        F.when(F.col(form) == "psm", F.concat(between(p, s), middle, between(s, m)))
        .when(F.col(form) == "spm", F.concat(between(p, m), middle, between(s, p)))
        .otherwise(F.col(output))
    )
