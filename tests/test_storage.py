"""Month tables, CSV exports, the monthly run, incremental load and the shared folder."""

import datetime
import glob

import pytest
from pyspark.sql import functions as F

from daywise import plans, session, sinks, sources as src
from daywise.functions import fixed_values as fv
from daywise.operators import normalise_usage
from daywise.streaming import compact, ingest_incremental, latest_per_key, read_ingested, store_batch

TABLE = "k BIGINT, n BIGINT, ym STRING"


def read(spark, path, schema=TABLE):
    return spark.read.schema(schema).parquet(path)


def test_rerun_replaces_only_its_months(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    both = rows(TABLE, [(1, 10, "202501"), (2, 20, "202502")])
    sinks.write_month_table(both, path)
    sinks.write_month_table(both, path)
    assert rows.of(read(spark, path)) == [(1, 10, "202501"), (2, 20, "202502")]
    sinks.write_month_table(rows(TABLE, [(3, 30, "202502")]), path)
    assert rows.of(read(spark, path)) == [(1, 10, "202501"), (3, 30, "202502")]


def test_write_without_shuffle(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.write_month_table(rows(TABLE, [(1, 10, "202501"), (2, 20, "202502")]), path, rebalance=False)
    assert rows.of(read(spark, path)) == [(1, 10, "202501"), (2, 20, "202502")]


def test_month_scan_reads_only_its_partition(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_month_table(rows(TABLE, [(i, i, f"2025{i:02d}") for i in range(1, 7)]), path)
    df = src.scan_month(src.read_month_table(spark, path, TABLE), "202502", "202503")
    assert rows.of(df) == [(2, 2, "202502"), (3, 3, "202503")]
    assert "PartitionFilters: [isnotnull(ym" in df._jdf.queryExecution().toString()
    assert len(df.inputFiles()) == 6  # the listing; pruning happens at planning


def test_table_by_name(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_month_table(rows(TABLE, [(1, 10, "202501")]), path)
    assert rows.of(sinks.register_table(spark, path, "stored_days", TABLE)) == [(1, 10, "202501")]
    sinks.write_month_table(rows(TABLE, [(2, 20, "202502")]), path)
    again = sinks.register_table(spark, path, "stored_days", TABLE)
    assert rows.of(again) == [(1, 10, "202501"), (2, 20, "202502")]
    other = str(tmp_path / "other")
    sinks.write_month_table(rows(TABLE, [(9, 90, "202501")]), other)
    with pytest.raises(ValueError, match="already stands for"):
        sinks.register_table(spark, other, "stored_days", TABLE)
    assert rows.of(sinks.register_table(spark, f"file://{path}/", "stored_days", TABLE)) == rows.of(again)
    spark.sql("drop table stored_days")
    assert read(spark, path).count() == 2


def test_csv_starts_with_bom_and_is_one_file(spark, rows, tmp_path):
    path = str(tmp_path / "c")
    df = rows("`사용일자` DATE, n BIGINT", [(datetime.date(2025, 1, d), d) for d in range(1, 20)])
    sinks.write_csv(df.repartition(4), path, bom=True, even=True)
    (file,) = glob.glob(f"{path}/*.csv")
    with open(file, "rb") as f:
        data = f.read()
    assert data.startswith(b"\xef\xbb\xbf" + "사용일자,n\n".encode())
    assert data.count(b"\n") == 20


# The monthly run


def raw_month(folder, month="202501"):
    bus = "USE_YMD,RTE,GTON_TNOPE,GTOFF_TNOPE\n" + "".join(
        f"{month}{d:02d},r{r},{d},{r}\n" for d in (3, 4, 5, 6) for r in (1, 2)
    )
    subway = "사용일자,호선명,승차총승객수,하차총승객수\n" + "".join(
        f"{month}{d:02d},2호선,{10 * d},1\n" for d in (3, 4, 5, 6)
    )
    subway += f"{month}xx,2호선,1,1\n"
    weather = "TM,STN,TA_AVG,TA_MAX,TA_MIN,RN_DAY\n" + (
        f"{month}03,108,1,35.5,0,\n{month}03,90,1,1,1,50\n"
        f"{month}04,108,1,2,-15.0,20.0\n{month}05,108,1,2,0,-9.0\n"
    )
    dust = "TM,STN_ID,PM10,FLAG\n" + (
        f"{month}030000,108,30,평\n{month}030100,90,32,평\n{month}040000,108,x,평\n{month}050000,108,151,평\n"
    )
    for name, text in {"bus": bus, "subway": subway, "weather": weather, "dust": dust}.items():
        path = folder / fv.INPUT_FILES[name].format(month=month)
        path.write_bytes(text.encode(fv.INPUT_CHARSETS[name]))


def test_monthly_run(spark, rows, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    raw_month(raw)
    table, export = str(tmp_path / "table"), str(tmp_path / "export")
    for _ in range(2):
        stored = plans.run_month(spark, str(raw), "202501", table, export)
    day = [datetime.date(2025, 1, d) for d in (3, 4, 5)]
    assert rows.of(stored) == [
        (day[0], 0.0, "none", 9, 31, 31.0, "normal", "heatwave", "weekday", "202501"),
        (day[1], 20.0, "heavy", 11, 41, None, "unknown", "coldwave", "weekend", "202501"),
        (day[2], -9.0, "none", 13, 51, 151.0, "very bad", "normal", "weekend", "202501"),
    ]
    back = src.read_csv(spark, export)
    assert back.columns == list(fv.PUBLISHED_NAMES.values()) and back.count() == 3
    assert plans.table_names(stored).columns == [
        "use_date", "rain_day", "is_rainy", "bus_passenger", "subway_passenger", "avg_pm10",
        "dust_grade", "severe_weather", "is_weekday", "YYYYMM",
    ]


def test_temperature_and_station_reports_from_raw_files(spark, rows, tmp_path):
    raw_month(tmp_path)
    inputs = plans.read_inputs(spark, str(tmp_path), "202501")
    days = plans.days_with_temperature(plans.merge_inputs(**inputs))
    assert rows.of(days) == [
        (datetime.date(2025, 1, 3), "weekday", 1.0, 40),
        (datetime.date(2025, 1, 4), "weekend", 1.0, 52),
        (datetime.date(2025, 1, 5), "weekend", 1.0, 64),
    ]
    assert [r.n_days for r in plans.report_temp_sensitivity(days).collect()] == [2]
    bus = src.read_csv(spark, str(tmp_path / fv.INPUT_FILES["bus"].format(month="202501")), charset="cp949")
    usage = normalise_usage(bus, {**fv.BUS_COLUMNS, "station": "RTE"})
    profile = {r.station: r.weekday_mean for r in plans.station_profile(usage).collect()}
    assert profile == {"r1": 5.5, "r2": 6.5}


def test_second_month_is_added(spark, tmp_path):
    raw_month(tmp_path, "202501")
    raw_month(tmp_path, "202502")
    table = str(tmp_path / "table")
    for month in ("202501", "202502"):
        plans.run_month(spark, str(tmp_path), month, table)
    stored = src.read_month_table(spark, table, plans.DAILY_SCHEMA)
    assert {r.ym: r["count"] for r in stored.groupBy("ym").count().collect()} == {"202501": 3, "202502": 3}


def test_year_is_its_months(spark, rows, tmp_path):
    raw_month(tmp_path, "202501")
    raw_month(tmp_path, "202502")
    year = plans.run_year(spark, str(tmp_path), "2025", str(tmp_path / "a"))
    for month in ("202501", "202502"):
        plans.run_month(spark, str(tmp_path), month, str(tmp_path / "b"))
    months = src.read_month_table(spark, str(tmp_path / "b"), plans.DAILY_SCHEMA)
    assert rows.of(year) == rows.of(months)
    bare = plans.run_year(spark, str(tmp_path), "2025", str(tmp_path / "c"), str(tmp_path / "d"), with_dust=False)
    assert rows.of(bare.select("avg_pm", "dust_grade").distinct()) == [(None, "unknown")]
    assert rows.of(bare.drop("avg_pm", "dust_grade")) == rows.of(year.drop("avg_pm", "dust_grade"))
    assert src.read_csv(spark, str(tmp_path / "d")).count() == 6


def test_run_leaves_the_neighbour_and_empties_its_own(spark, rows, tmp_path):
    raw_month(tmp_path, "202501")
    raw_month(tmp_path, "202502")
    table = str(tmp_path / "table")
    for month in ("202501", "202502"):
        plans.run_month(spark, str(tmp_path), month, table)

    def counts():
        stored = src.read_month_table(spark, table, plans.DAILY_SCHEMA)
        return {r.ym: r["count"] for r in stored.groupBy("ym").count().collect()}

    name = fv.INPUT_FILES["weather"].format(month="202501")
    kept = (tmp_path / name).read_bytes()
    late = [(tmp_path / fv.INPUT_FILES[k].format(month="202501")) for k in ("bus", "subway", "weather")]
    for path, line in zip(late, ("20250201,r,1,1\n", "20250201,l,1,1\n", "20250201,108,1,1,1,1\n")):
        path.write_bytes(path.read_bytes() + line.encode())
    with pytest.raises(Exception, match="days of other months"):
        plans.run_month(spark, str(tmp_path), "202501", table)
    assert counts() == {"202501": 3, "202502": 3}
    (tmp_path / name).write_bytes(kept.replace(b",108,", b",90,"))
    plans.run_month(spark, str(tmp_path), "202501", table)
    assert counts() == {"202502": 3}


def files_of(folder, month, *names):
    return [folder / fv.INPUT_FILES[name].format(month=month) for name in names]


def test_year_keeps_months_that_lack_a_file(spark, rows, tmp_path):
    table = str(tmp_path / "table")
    for month in ("202501", "202502", "202503"):
        raw_month(tmp_path, month)
        plans.run_month(spark, str(tmp_path), month, table)
    before = rows.of(src.read_month_table(spark, table, plans.DAILY_SCHEMA))
    # February lacks a file, March has an empty one; January is computed again.
    (late,) = files_of(tmp_path, "202502", "dust")
    late.unlink()
    (empty,) = files_of(tmp_path, "202503", "bus")
    empty.write_bytes(b"")
    stored = plans.run_year(spark, str(tmp_path), "2025", table)
    assert {r.ym for r in stored.collect()} == {"202501"}
    assert rows.of(src.read_month_table(spark, table, plans.DAILY_SCHEMA)) == before
    with pytest.raises(ValueError, match="no month of 2024"):
        plans.run_year(spark, str(tmp_path), "2024", table)


def test_charset_is_found_for_each_file_of_a_year(spark, rows, tmp_path):
    for month in ("202501", "202502", "202503"):
        raw_month(tmp_path, month)
    want = rows.of(plans.run_year(spark, str(tmp_path), "2025", str(tmp_path / "a")))
    for month, charset in (("202501", "utf-8"), ("202502", "utf-8-sig"), ("202503", "utf-16")):
        for path in files_of(tmp_path, month, "bus", "subway", "weather", "dust"):
            try:
                text = path.read_bytes().decode()
            except UnicodeDecodeError:
                text = path.read_bytes().decode("cp949")
            path.write_bytes(text.encode(charset))
    assert rows.of(plans.run_year(spark, str(tmp_path), "2025", str(tmp_path / "b"))) == want


@pytest.mark.parametrize("content", [b"when,who\n1,2\n", b"TM,STN\n\xff\xff\n"])
def test_unknown_files_fail_before_anything_is_replaced(spark, rows, tmp_path, content):
    raw_month(tmp_path, "202501")
    table = str(tmp_path / "table")
    before = rows.of(plans.run_month(spark, str(tmp_path), "202501", table))
    raw_month(tmp_path, "202502")
    (weather,) = files_of(tmp_path, "202502", "weather")
    weather.write_bytes(content)
    with pytest.raises(plans.UnknownLayout, match="weather_data_202502"):
        plans.run_year(spark, str(tmp_path), "2025", table)
    with pytest.raises(plans.UnknownLayout):
        plans.run_month(spark, str(tmp_path), "202502", table)
    assert rows.of(src.read_month_table(spark, table, plans.DAILY_SCHEMA)) == before


def test_year_takes_one_of_two_weather_files(spark, rows, tmp_path):
    raw_month(tmp_path, "202501")
    month, year = (tmp_path / fv.INPUT_FILES["weather"].format(month=m) for m in ("202501", "2025"))
    year.write_bytes(month.read_bytes().replace(b"-9.0", b"30.0"))
    rain = {}
    for which in ("monthly", "yearly"):
        stored = plans.run_year(spark, str(tmp_path), "2025", str(tmp_path / which), weather=which)
        rain[which] = [r.rain_day for r in stored.orderBy("use_date").collect()]
    assert rain == {"monthly": [0.0, 20.0, -9.0], "yearly": [0.0, 20.0, 30.0]}


# Incremental load

INGESTED = "id BIGINT, n BIGINT, day DATE, ym STRING"


class Landing:
    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.n_files = 0
        (path / "landing").mkdir()

    def deliver(self, *lines):
        import os
        import time

        self.n_files += 1
        file = self.path / "landing" / f"{self.n_files:03d}.csv"
        file.write_text("id,n,day\n" + "".join(f"{line}\n" for line in lines))
        stamp = time.time() + 10 * self.n_files
        os.utime(file, (stamp, stamp))

    def take_in(self, checkpoint="checkpoint", files_per_batch=None, key=()):
        ingest_incremental(
            self.spark,
            f"{self.path}/landing",
            "id BIGINT, n BIGINT, day DATE",
            lambda raw: raw.withColumn("ym", F.date_format("day", "yyyyMM")),
            f"{self.path}/table",
            f"{self.path}/quarantine",
            f"{self.path}/{checkpoint}",
            files_per_batch,
            key,
        )
        return self.stored("table")

    def stored(self, name):
        table = read_ingested(self.spark, f"{self.path}/{name}", INGESTED, ["id"])
        return sorted((r.id, r.n, r.day.day) for r in table.collect())


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_redelivery_changes_nothing(landing):
    landing.deliver("1,10,2025-01-01", "2,20,2025-01-02")
    want = [(1, 10, 1), (2, 20, 2)]
    assert landing.take_in() == want
    landing.deliver("2,20,2025-01-02")
    assert landing.take_in() == want
    assert landing.take_in() == want
    assert landing.take_in("fresh") == want


def test_day_in_parts_and_correction(landing):
    landing.deliver("1,10,2025-01-01", "2,20,2025-01-01")
    landing.deliver("3,30,2025-01-01", "4,40,2025-01-02")
    landing.deliver("1,11,2025-01-01")
    want = [(1, 11, 1), (2, 20, 1), (3, 30, 1), (4, 40, 2)]
    assert landing.take_in(files_per_batch=1) == want
    assert landing.take_in("fresh") == want


def test_two_copies_in_one_batch(landing):
    landing.deliver("1,10,2025-01-01")
    landing.deliver("1,10,2025-01-01")
    assert landing.take_in() == [(1, 10, 1)]


def test_rows_without_a_day_are_kept_apart(landing, spark):
    landing.deliver("1,10,2025-01-01", "2,20,")
    landing.take_in()
    landing.deliver("3,30,", "4,40,2025-01-01")
    assert landing.take_in() == [(1, 10, 1), (4, 40, 1)]
    lost = spark.read.schema(f"{INGESTED}, _arrival STRUCT<time: TIMESTAMP, file: STRING>")
    lost = lost.parquet(f"{landing.path}/quarantine").collect()
    assert sorted((r.id, r._arrival.file[-7:]) for r in lost) == [(2, "001.csv"), (3, "002.csv")]


def test_later_line_of_a_file_counts(landing, spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        early = [f"{i},{i},2025-01-01" for i in range(3000)]
        landing.deliver(*early, *[f"{i},{i + 1},2025-01-01" for i in range(3000)], *[f"{i},{i + 2},2025-01-01" for i in range(3000)])
        want = [(i, i + 2, 1) for i in range(3000)]
        assert landing.take_in() == want
        assert landing.take_in("fresh") == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_without_a_key_are_kept_apart(landing, spark):
    landing.deliver("1,10,2025-01-01", ",20,2025-01-01", ",30,2025-01-02", ",40,")
    assert landing.take_in(key=["id"]) == [(1, 10, 1)]
    lost = spark.read.schema(f"{INGESTED}, _reason STRING").parquet(f"{landing.path}/quarantine").collect()
    assert sorted((r.n, r._reason) for r in lost) == [(20, "no key"), (30, "no key"), (40, "no day")]


def test_batch_written_again_replaces_itself(spark, rows, tmp_path):
    def batch(n):
        arrival = "_arrival STRUCT<time: TIMESTAMP, file: STRING, block: BIGINT, at: BIGINT>"
        stamp = (datetime.datetime(2025, 1, 1), "f", 0, 0)
        return rows(f"{INGESTED}, {arrival}", [(1, n, datetime.date(2025, 1, 1), "202501", stamp), (2, n, None, None, stamp)])

    for n in (1, 2):
        store_batch(batch(n), "run-0", str(tmp_path / "t"), str(tmp_path / "q"))
    assert [r.n for r in read_ingested(spark, str(tmp_path / "t"), INGESTED, ["id"]).collect()] == [2]
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1


@pytest.mark.parametrize("days, reads, lost", [((1, 2, 3), 1, []), ((1, None, 3), 2, [2]), ((None, None, None), 2, [1, 2, 3]), ((), 1, [])])
def test_batch_without_unfit_rows_is_read_once(spark, rows, tmp_path, days, reads, lost):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    held = [(i, i, day and datetime.date(2025, 1, day), "202501") for i, day in enumerate(days, 1)]
    source = rows(INGESTED, held)
    store_batch(source.mapInArrow(count, source.schema), "run-0", str(tmp_path / "t"), str(tmp_path / "q"))
    assert seen.value == reads * len(days)
    found = spark.read.schema(f"{INGESTED}, _reason STRING").parquet(str(tmp_path / "q")).collect()
    assert sorted((r.id, r._reason) for r in found) == [(i, "no day") for i in lost]
    assert spark.read.schema(INGESTED).parquet(str(tmp_path / "t")).count() == len(days) - len(lost)


def test_compaction_keeps_what_is_read(landing, spark):
    landing.deliver("1,10,2025-01-01", "2,20,2025-01-01")
    landing.take_in()
    landing.deliver("1,11,2025-01-01")
    want = landing.take_in()
    compact(spark, f"{landing.path}/table", INGESTED, ["id"], f"{landing.path}/small")
    assert landing.stored("small") == want == [(1, 11, 1), (2, 20, 1)]


def test_latest_keeps_nulls(rows):
    df = rows("k INT, v INT, o INT", [(1, 5, 1), (1, None, 2), (2, 7, 1)])
    assert rows.of(latest_per_key(df, ["k"], ["o"])) == [(1, None), (2, 7)]


# The shared folder


def test_shared_folder_is_the_named_one(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark)
    assert folder == named.rstrip("/") if named else folder
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


class Unset:
    """A session without the setting."""

    def __init__(self, master):
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"
        self.conf = self

    def getConf(self):
        return self

    def get(self, key, default=None):
        return default


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Unset("spark://host:7077"))
    assert session.shared_folder(Unset("local[2]")) == session.shared_folder(Unset("local[2]"))
