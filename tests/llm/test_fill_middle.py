"""Fill-in-the-middle: ranks and cuts against plain counting, round trips, and the SQL twin."""

import hashlib
import random
import re

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from daywise.llm.fill_middle import Cutter, WaveletMatrix, check_marks, fill_in_middle, restored

SF = "/root/testdata/sf0.01"


def plain_fim(name, text, seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_query_agrees_with_sql(spark):
    frame = queries()["op13_wavelet_middle"](spark, SF)
    assert differences(frame, connect(SF), oracle_sql()["op13_wavelet_middle"]) == []


def test_ranks_are_counts():
    draw = random.Random(1)
    for n in (0, 1, 7, 8, 9, 511, 512, 513, 3000):
        codes = np.array([draw.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)], np.uint8)
        matrix = WaveletMatrix(codes)
        for i in {0, n, n // 2, *(draw.randint(0, n) for _ in range(20))}:
            assert [matrix.rank(c, i) for c in range(4)] == [int((codes[:i] == c).sum()) for c in range(4)]


UNIT = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^\n.!?。]*[\n.!?。]|[^\n.!?。]+", "word": r"[^ \t\n]*[ \t\n]|[^ \t\n]+", "character": r"(?s)."}


@pytest.mark.parametrize("unit", UNIT)
def test_cuts_fall_between_units(unit):
    draw = random.Random(2)
    for n in (0, 1, 2, 5, 40, 700):
        text = "".join(draw.choice("ab é\n.!\U0001f600。\t") for _ in range(n))
        cutter, units = Cutter(text, unit), re.findall(UNIT[unit], text)
        assert cutter.units == len(units) and "".join(units) == text
        assert [cutter.after(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "one line\n", "a\nb\nc", "a\r\nb\r\n", "has <P> inside\nand more", "almost <P\n>S><M\n<", "<\n<\n>",
    "\U0001f600é\n" * 30, "x" * 200_000 + "\n" + "y\n" * 5000, "nul \0 in it\nline\n",
]


def test_outputs_and_round_trip(spark):
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)] + [(5, TEXTS[6], "same row"), (5, TEXTS[6], "same row"), (None, "a\nb\n", "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    for rate, spm in ((100, 50), (100, 0), (100, 100), (40, 50), (0, 50)):
        made = fill_in_middle(docs, rate=rate, spm=spm).withColumn("again", restored())
        got = sorted((tuple(r) for r in made.collect()), key=str)
        want = [(i, *plain_fim("" if i is None else i, t, rate=rate, spm=spm), t or "") for i, t, _ in rows]
        assert got == sorted(want, key=str)


def test_other_units_and_marks_round_trip(spark):
    docs = spark.createDataFrame([(i, (t or "") + " Some words. More of them!") for i, t in enumerate(TEXTS)], "doc_id long, text string")
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    for unit in UNIT:
        made = fill_in_middle(docs, unit=unit, seed=3, marks=marks)
        back = made.withColumn("again", restored(marks=marks)).join(docs, "doc_id")
        assert back.filter("again <> text").count() == 0
        assert back.filter("form <> 'plain'").count() == len(TEXTS)


def test_empty_table_and_text_ids(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    row = fill_in_middle(spark.createDataFrame([("k1", "a\nb\n")], "doc_id string, text string")).first()
    assert tuple(row)[1:] == plain_fim("k1", "a\nb\n")


@pytest.mark.parametrize("marks", [("", "b", "c"), ("<a", "a>", "x"), ("aa", "b", "c"[:0] or "dbd"), ("aba", "c", "d")])
def test_marks_that_cannot_be_told_apart(marks):
    with pytest.raises(ValueError):
        check_marks(marks)


def test_nothing_is_shuffled(spark):
    made = fill_in_middle(spark.read.parquet(f"{SF}/documents.parquet")).select("form", F.sha2("output", 256))
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
