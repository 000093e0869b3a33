"""Exact dedup: fingerprints against plain polynomials, groups against plain grouping, collisions, and the SQL twin."""

import hashlib
import random
from collections import defaultdict

import pytest
from compare import connect, differences

from __spark_entry__ import oracle_sql, queries
from daywise.llm.exact_dedup import BASES, MODULI, drop_copies, equal_texts, fingerprint, fingerprints, hash_piece, shifted

SF = "/root/testdata/sf0.01"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    return groups


def check(frame, rows):
    """One row for each, right groups, one kept of each group and that of the largest id."""
    got = [r.asDict() for r in frame.collect()]
    by = defaultdict(list)
    for r in got:
        by[r["text_sha256"]].append(r)
    want = plain(rows)
    assert by.keys() == {hashlib.sha256(t.encode()).hexdigest() for t in want}
    for text, ids in want.items():
        found = by[hashlib.sha256(text.encode()).hexdigest()]
        assert sorted(str(r["doc_id"]) for r in found) == sorted(map(str, ids))
        top = max((i for i in ids if i is not None), default=None)
        assert {(r["keep_id"], r["group_size"]) for r in found} == {(top, len(ids))}
        assert [r["doc_id"] for r in found if r["kept"]] == [top]


def test_query_agrees_with_sql(spark):
    frame = queries()["op12_polynomial_dedup"](spark, SF)
    assert differences(frame, connect(SF), oracle_sql()["op12_polynomial_dedup"]) == []


def test_fingerprints_are_polynomials():
    draw = random.Random(3)
    for n in (0, 1, 15, 16, 17, 100):
        data = bytes(draw.randrange(256) for _ in range(n))
        want = tuple(sum(b * pow(base, n - 1 - i, m) for i, b in enumerate(data)) % m for base, m in zip(BASES, MODULI))
        assert fingerprint(data, size=16)[1:] == want == fingerprint(data, size=7)[1:] == fingerprint(data)[1:]


def test_pieces_combine_in_any_order():
    data = bytes(range(200)) * 3
    pieces = [(data[i : i + 64], len(data) - i - len(data[i : i + 64])) for i in range(0, len(data), 64)]
    random.Random(4).shuffle(pieces)
    parts = [shifted(hash_piece(p, size=64), after) for p, after in pieces]
    assert tuple(sum(h) % m for h, m in zip(zip(*parts), MODULI)) == fingerprint(data)[1:]


TEXTS = ["", None, "Same", "same", "SAME ", "É", "é", "K", "K", "k", "a" * 5000, "A" * 5000, "a" * 4999 + "b", "b" + "a" * 4999, "\0", "\0\0"]


def rows_with_ties():
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(2, "same"), (3, "same"), (3, "same"), (None, "SAME"), (None, "only here"), (None, "Only here")]
    return rows + [(100 + i, "hot Copy" if i % 2 else "hot copy") for i in range(300)]


@pytest.mark.parametrize("size", [1 << 16, 16])
def test_groups(spark, size):
    rows = rows_with_ties()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, f1 int").repartition(4)
    check(equal_texts(docs, size=size), rows)


def test_huge_texts_are_dealt_out_by_piece(spark):
    rows = [(1, "Xy" * 100_000), (2, "xY" * 100_000), (3, "xy" * 99_999 + "yx"), (4, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(equal_texts(docs), rows)
    told = {r.doc_id: (r.n_bytes, r.f1, r.f2) for r in fingerprints(docs).collect()}
    assert told == {i: fingerprint(lowered(t).encode()) for i, t in rows}


@pytest.mark.parametrize("size", [1 << 16, 4])
def test_texts_that_collide_are_told_apart(spark, size):
    # Modulo 2 and 3 most texts of one length share a fingerprint.
    draw = random.Random(5)
    rows = [(i, "".join(draw.choice("abAB") for _ in range(draw.randint(0, 9)))) for i in range(400)]
    rows += [(i % 7, t) for i, t in rows[:50]] + [(None, "ab"), (None, "AB"), (None, "ba"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(equal_texts(docs, moduli=(2, 3), size=size), rows)


def test_drop_copies_keeps_columns(spark):
    rows = [(1, "a", "p"), (2, "A", "q"), (None, "b", "r"), (2, "A", "q"), (3, None, "s"), (4, "", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    assert sorted(map(tuple, drop_copies(docs).collect()), key=str) == sorted([(2, "A", "q"), (None, "b", "r"), (4, "", "t")], key=str)


def test_empty_table(spark):
    assert equal_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []
