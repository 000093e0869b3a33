"""Files in several encodings, text answers, JSON pages."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daywise import operators as op, sources as src
from daywise.functions.fixed_values import WEATHER_COLUMNS

TEXT = "사용일자,구분,승객수\n20250101,평일,10\n20250104,주말,20\n"
ROWS = [("20250101", "평일", "10"), ("20250104", "주말", "20")]


@pytest.fixture
def folder(tmp_path):
    def write(name, data):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
        return str(path)

    write.path = str(tmp_path)
    return write


def test_file_named_euc_kr_with_a_wider_syllable(spark, rows, folder):
    path = folder("a.csv", "역,n\n뷁,1\n".encode("cp949"))
    assert rows.of(src.read_csv(spark, path, charset="EUC-KR")) == [("뷁", "1")]


@pytest.mark.parametrize("charset", ["utf-8", "utf-8-sig", "cp949"])
def test_csv_in_each_charset(spark, rows, folder, charset):
    path = folder("a.csv", TEXT.encode(charset))
    read_as = "utf-8" if charset == "utf-8-sig" else charset
    df = src.read_csv(spark, path, charset=read_as)
    assert df.columns == ["사용일자", "구분", "승객수"]
    assert rows.of(df) == ROWS


def test_csv_with_schema_in_cp949(spark, rows, folder):
    schema = T.StructType.fromDDL("d INT, kind STRING, n BIGINT")
    path = folder("a.csv", TEXT.encode("cp949"))
    want = [(20250101, "평일", 10), (20250104, "주말", 20)]
    assert rows.of(src.read_csv(spark, path, schema, "cp949")) == want


def test_csv_by_reader_where_session_allows(spark, rows, folder):
    path = folder("a.csv", TEXT.encode("cp949"))
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        df = src.read_csv(spark, path, charset="cp949")
        assert rows.of(df) == ROWS
        assert "ArrowEvalPython" not in df._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_wrong_declared_charset_fails(spark, folder):
    path = folder("a.csv", TEXT.encode("cp949") + b"\xff\xff\n")
    with pytest.raises(Exception, match="UnicodeDecodeError"):
        src.read_csv(spark, path, charset="cp949").collect()


def test_glob_picks_by_name(spark, rows, folder):
    for name in ("BUS_1.csv", "BUS_2.csv", "SUBWAY_1.csv", "BUS_3.txt"):
        folder(name, b"x\n1\n")
    df = src.read_csv(spark, folder.path, glob="BUS_*.csv")
    assert df.count() == 2
    folders = src.read_csv(spark, folder.path, glob="SUB*").select(src.source_folder())
    assert folders.first()[0] == folder.path.rsplit("/", 1)[1]


def test_recode_skips_empty_and_broken_files(spark, rows, folder):
    folder("in/a.csv", TEXT.encode("utf-8"))
    folder("in/b.csv", TEXT.encode("utf-8-sig"))
    folder("in/c 한글.csv", TEXT.encode("cp949"))
    folder("in/d.csv", b"")
    folder("in/e.csv", TEXT.encode("utf-8") + b"\xff\n")
    lines, status = src.recode_lines(spark, f"{folder.path}/in")
    name = F.element_at(F.split(F.url_decode("file"), "/"), -1)
    got = dict(rows.of(status.select(name, "status")))
    assert got == {
        "a.csv": "utf-8",
        "b.csv": "utf-8-sig",
        "c 한글.csv": "cp949",
        "e.csv": "undecodable",
    }
    per_file = {}
    for r in lines.collect():
        per_file.setdefault(r.file, []).append(r.line)
    assert len(per_file) == 3
    assert all(sorted(v) == sorted(TEXT.split()) for v in per_file.values())


def test_charset_is_decided_on_the_whole_file(spark, rows, folder):
    folder("in/late.csv", b"a,b\n" * 50_000 + "한글\n".encode("cp949"))
    status = src.file_status(spark, f"{folder.path}/in")
    assert [r.status for r in status.collect()] == ["cp949"]


def test_recoded_files_are_written_as_utf8(spark, rows, folder):
    import glob

    folder("in/a.csv", TEXT.encode("cp949"))
    folder("in/b.csv", b"\xef\xbb\xbf" + TEXT.encode())
    lines, _ = src.recode_lines(spark, f"{folder.path}/in")
    src.write_recoded(lines, f"{folder.path}/out", f"{folder.path}/in/")
    for name in ("a.csv", "b.csv"):
        (part,) = glob.glob(f"{folder.path}/out/file={name}/*.txt")
        with open(part, "rb") as f:
            assert f.read().decode() == "\ufeff" + "".join(f"{line}\n" for line in TEXT.split())


def test_charset_of_a_file_holds_for_all_its_lines(spark, rows, folder):
    # In cp949 these two words are bytes of UTF-8 for other letters.
    text = "짜,1\n쨩,2\n한글,3\n"
    folder("in/odd.csv", text.encode("cp949"))
    folder("in/both.csv", "한글\n".encode() + "한글\n".encode("cp949") + b"\xed\x95\n")
    lines, status = src.recode_lines(spark, f"{folder.path}/in")
    assert sorted(r.line for r in lines.collect()) == sorted(text.split())
    assert sorted(r.status for r in status.collect()) == ["cp949", "undecodable"]


WIDE = {"utf-16-le": "utf-16-le", "utf-16-be": "utf-16-be", "bom-le": "utf-16-le", "bom-be": "utf-16-be"}


def test_charsets_of_two_bytes_are_found_and_decoded(spark, rows, folder):
    text = "날짜,값\r\n2025,한글 1\r\n2026,\ub00a\r\n2027,x\r\n"
    for name, charset in WIDE.items():
        folder(f"in/{name}", (text if name.startswith("utf") else "\ufeff" + text).encode(charset))
    folder("in/sig", b"\xef\xbb\xbf" + text.encode())
    folder("in/sig-open", b"\xef\xbb\xbf" + text.strip().encode())
    folder("in/plain", text.encode())
    folder("in/torn", ("\ufeff" + text).encode("utf-16-le") + b"\x00\xd8")
    lines, status = src.recode_lines(spark, f"{folder.path}/in")
    name = F.element_at(F.split("file", "/"), -1)
    want = WIDE | {"sig": "utf-8-sig", "sig-open": "utf-8-sig", "plain": "utf-8", "torn": "undecodable"}
    assert dict(rows.of(status.select(name, "status"))) == want
    got = {}
    for r in lines.select(name.alias("name"), "line", "block", "at").orderBy("block", "at").collect():
        got.setdefault(r.name, []).append(r.line)
    assert got == {n: text.split("\r\n")[:-1] for n in want if n != "torn"}


def test_the_first_charset_that_decodes_all_lines(spark, rows, folder):
    folder("in/a", "ｱｲｳ\n".encode("shift_jis") + b"x\n")
    folder("in/b", TEXT.encode("cp949"))
    status = src.file_status(spark, f"{folder.path}/in", ["cp949", "shift_jis", "latin-1"])
    name = F.element_at(F.split("file", "/"), -1)
    assert dict(rows.of(status.select(name, "status"))) == {"a": "shift_jis", "b": "cp949"}


def test_files_of_one_name_stay_apart(spark, rows, folder):
    import glob

    for top, word in (("a", "하나"), ("b", "둘")):
        folder(f"in/{top}/f.csv", f"{word}\n".encode("cp949") * 3)
    lines, _ = src.recode_lines(spark, f"{folder.path}/in")
    src.write_recoded(lines, f"{folder.path}/out", f"file://{folder.path}/in")
    back = spark.read.text(f"{folder.path}/out").select("file", "value")
    assert rows.of(back.distinct()) == [("a/f.csv", "하나"), ("b/f.csv", "둘")]
    assert back.count() == 6 and len(glob.glob(f"{folder.path}/out/file=*")) == 2


BAD = "k,n\n1,10\nk,n\n2,x\n3\n4,6,7\n\n5,50\n"


@pytest.mark.parametrize("charset", ["utf-8", "cp949", "utf-16-le"])
@pytest.mark.parametrize("java", ["true", "false"])
def test_malformed_rows_stay_visible(spark, rows, folder, charset, java):
    path = folder("in/a.csv", BAD.encode(charset))
    folder("in/b.csv", "k,n\n6,60\n".encode(charset))
    schema = rows("k INT, n INT", []).schema
    spark.conf.set("spark.sql.legacy.javaCharsets", java)
    try:
        df = src.read_csv(spark, path.rsplit("/", 1)[0], schema, charset=charset, corrupt="_line")
        want = [(1, 10, None), (2, None, "2,x"), (3, None, "3"), (4, 6, "4,6,7"), (5, 50, None), (6, 60, None), (None, None, "k,n")]
        assert rows.of(df) == sorted(want, key=str)
        sound = src.keep_sound(df, "_line", f"{folder.path}/bad")
        assert rows.of(sound) == [(1, 10), (5, 50), (6, 60)]
        assert sorted(r._line for r in spark.read.parquet(f"{folder.path}/bad").collect()) == ["2,x", "3", "4,6,7", "k,n"]
        bare = src.read_csv(spark, path, charset=charset)
        assert bare.columns[1] == "n" and bare.count() == 6
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_header_of_a_file_in_parts_is_dropped_once(spark, rows, folder):
    text = "k,n\n" + "".join(f"{i},가\n" for i in range(50_000)) + "k,n\n"
    path = folder("big.csv", text.encode("cp949"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = src.read_csv(spark, path, rows("k STRING, n STRING", []).schema, charset="cp949")
        assert df.rdd.getNumPartitions() > 3
        assert df.count() == 50_001 and df.filter("k = 'k'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_expected_files_without_lines_are_skipped(spark, rows, folder):
    folder("in/a.csv", TEXT.encode())
    folder("in/empty.csv", b"")
    files = [f"file://{folder.path}/in/{n}" for n in ("a.csv", "empty.csv")]
    status = src.file_status(spark, f"{folder.path}/in", expected=rows("file STRING", [(f,) for f in files]))
    assert rows.of(status) == [(files[0], "utf-8"), (files[1], "skipped")]


def test_whitespace_text(spark, rows, folder):
    text = "# TM STN PM10\n\n   \n202501010000 108 35 A\n202501010100  108   4x  B  = extra\n202501010200 90\n"
    df = src.parse_ws_text(spark.read.text(folder("d.txt", text.encode())))
    assert rows.of(df) == [
        ("202501010000", "108", "35", "A"),
        ("202501010100", "108", "4x", "B"),
        ("202501010200", "90", None, None),
    ]
    day = datetime.date(2025, 1, 1)
    assert rows.of(op.normalise_dust(df)) == [(day, 108, 35), (day, 108, None), (day, 90, None)]


def weather_line(n=56, **given):
    return ",".join(str(given.get(c, "")) for c in WEATHER_COLUMNS[:n])


def test_positional_csv(spark, rows, folder):
    lines = [
        "#START",
        weather_line(TM=20250101, STN=108, RN_DAY=-9.0, TE_50=1.5),
        weather_line(TM=20250102, STN=108, TE_50=2.5) + ",",
        weather_line(TM=20250103, STN=108),
        weather_line(55, TM=20250104, STN=108),
        weather_line(TM=20250105, STN=108) + ",,",
        weather_line(TM=20250106, STN="x", TE_50=3.5) + ",# late",
        "",
    ]
    frame = spark.read.text(folder("w.txt", "\n".join(lines).encode()))
    got = src.parse_csv_positional(frame, {"TM": "int", "STN": "int", "RN_DAY": "double", "TE_50": "double"})
    assert rows.of(got) == sorted(
        [
            (True, 20250101, 108, -9.0, 1.5),
            (True, 20250102, 108, None, 2.5),
            (True, 20250103, 108, None, None),
            (False, None, None, None, None),
            (False, None, None, None, None),
            (True, 20250106, None, None, 3.5),
        ],
        key=str,
    )


def page(total, start, n):
    row = [{"id": i} for i in range(start, start + n)]
    return json.dumps({"svc": {"list_total_count": total, "row": row, "RESULT": {"CODE": "INFO-000"}}})


FAILURE = json.dumps({"RESULT": {"CODE": "INFO-200", "MESSAGE": "no data"}})


def test_pages(spark, rows):
    pages = rows(
        "day STRING, body STRING",
        [("d1", page(2005, s, n)) for s, n in ((1, 1000), (1001, 1000), (2001, 5))]
        + [("d2", page(2005, 1, 1000)), ("d2", page(2005, 2001, 5))]
        + [("d3", FAILURE)]
        + [("d4", page(5, 1, 5)), ("d4", FAILURE)],
    )
    assert rows.of(src.page_completeness(pages, "svc", ["day"])) == [
        ("d1", 3, 0, 2005, 2005, "complete"),
        ("d2", 2, 0, 1005, 2005, "incomplete"),
        ("d3", 1, 1, 0, None, "incomplete"),
        ("d4", 2, 1, 5, 5, "complete"),
    ]
    odd = rows("day STRING, n INT, body STRING", [("d", 1, page(4, 1, 2)), ("d", 1, page(4, 1, 2)), ("e", 1, page(2, 1, 2)), ("e", 1, page(2, 1, 2)), ("f", 1, "<html>502</html>"), ("f", 2, None)])
    assert rows.of(src.page_completeness(odd, "svc", ["day"], page="n")) == [
        ("d", 2, 0, 2, 4, "incomplete"), ("e", 2, 0, 2, 2, "complete"), ("f", 2, 2, 0, None, "incomplete"),
    ]
    flat = src.flatten_json_pages(odd.filter("day = 'f'"), "svc", "id BIGINT", ["n"])
    assert rows.of(flat) == [(1, "UNPARSABLE", None), (2, "UNPARSABLE", None)]
    flat = src.flatten_json_pages(pages, "svc", "id BIGINT", ["day"])
    assert flat.filter("day = 'd1'").agg(F.countDistinct("id")).first()[0] == 2005
    assert rows.of(flat.filter("error_code is not null")) == [
        ("d3", "INFO-200", None),
        ("d4", "INFO-200", None),
    ]


@pytest.mark.parametrize("stretch", [100_000, 2])
def test_gaps_and_overlaps_of_pages(spark, rows, stretch):
    sent = [
        ("overlap", 1, 4, 2), ("overlap", 2, 4, 2),
        ("whole", 1, 5, 2), ("whole", 3, 5, 3), ("whole", 3, 5, 3), ("whole", 3, 5, 1),
        ("doubled", 1, 5, 3), ("doubled", 2, 5, 4),
        ("inside", 1, 9, 9), ("inside", 2, 9, 1), ("inside", 5, 9, 2),
        ("gap", 1, 9, 2), ("gap", 6, 9, 2), ("beyond", 1, 3, 5), ("none", 1, 0, 0), ("empty", 1, 7, 0),
        (None, 1, 2, 2),
    ]
    pages = rows("day STRING, start INT, body STRING", [(d, s, page(t, s, n)) for d, s, t, n in sent] + [("failed", 1, FAILURE), ("whole", 1, FAILURE), ("whole", None, FAILURE)])
    got = rows.of(src.page_intervals(pages, "svc", ["day"], "start", stretch=stretch))
    assert got == sorted(
        [
            ("overlap", 4, 4, 1, 1, 0, "incomplete"), ("whole", 5, 5, 0, 0, 0, "complete"), ("doubled", 5, 7, 0, 2, 0, "doubled"),
            ("inside", 9, 12, 0, 3, 0, "doubled"), ("gap", 9, 4, 5, 0, 0, "incomplete"), ("beyond", 3, 5, 0, 0, 2, "incomplete"),
            ("none", 0, 0, 0, 0, 0, "complete"), ("empty", 7, 0, 7, 0, 0, "incomplete"), ("failed", None, 0, None, 0, None, "incomplete"),
            (None, 2, 2, 0, 0, 0, "complete"),
        ],
        key=str,
    )
