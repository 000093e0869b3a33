"""Reports on a small daily table."""

import datetime
import statistics

from daywise import plans
from daywise.functions import fixed_values as fv

DAYS = [datetime.date(2025, 1, d) for d in range(1, 15)]


def daily(rows):
    """Fourteen days; two weekends (4, 5, 11, 12)."""
    data = []
    for i, day in enumerate(DAYS):
        kind = "weekend" if day.weekday() >= 5 else "weekday"
        rain = ("heavy", "light", "none")[i % 3]
        dust = ("good", "normal", "bad", "very bad", "unknown")[i % 5]
        severe = "coldwave" if i % 2 else "normal"
        data.append((day, float(i), rain, 100 + i, 200 + i, 1.0, dust, severe, kind, "202501"))
    return rows(plans.DAILY_SCHEMA, data), data


def expected(data, column, kind):
    groups = {}
    for r in data:
        if r[8] == kind:
            groups.setdefault(r[column], []).append((r[3], r[4]))
    out = []
    for label, pairs in groups.items():
        for mode, j in (("mode_a", 0), ("mode_b", 1)):
            out.append((label, mode, float(int(statistics.mean(p[j] for p in pairs) + 0.5))))
    return sorted(out)


def test_rain_report_and_year_report(rows):
    frame, data = daily(rows)
    want = [(*r, fv.ENGLISH.rain.index(r[0]) + 1) for r in expected(data, 2, "weekday")]
    assert rows.of(plans.report_rain(frame)) == want
    assert rows.of(plans.report_year_rain(frame)) == want


def test_severe_report_has_no_order(rows):
    frame, data = daily(rows)
    assert rows.of(plans.report_severe(frame)) == expected(data, 7, "weekend")


def test_dust_report_leaves_unknown_without_place(rows):
    frame, data = daily(rows)
    places = {label: i + 1 for i, label in enumerate(fv.ENGLISH.dust)}
    want = sorted(((*r, places.get(r[0])) for r in expected(data, 6, "weekend")), key=str)
    assert rows.of(plans.report_dust(frame)) == want


def test_heavy_rain_days(rows):
    friday, saturday = DAYS[2], DAYS[3]
    df = rows("day DATE, rain DOUBLE", [(friday, 80.0), (friday, 79.9), (saturday, 90.0)])
    assert rows.of(plans.heavy_rain_days(df)) == [(friday, 80.0)]


def test_temperature_halves(rows):
    data = [(DAYS[i], "weekend", t, n) for i, (t, n) in enumerate([(1.0, 10), (2.0, 30), (3.0, 5), (9.0, 6), (None, 1)])]
    df = rows("day DATE, day_type STRING, tavg DOUBLE, total BIGINT", [*data, (DAYS[9], "weekday", 0.0, 999)])
    got = {r.half: (r.n_days, r.mean_total, r.range_total) for r in plans.report_temp_sensitivity(df).collect()}
    assert got == {"low": (2, 20.0, 20), "high": (2, 5.5, 1)}


def test_station_profile(rows):
    fri, sat, sun = DAYS[2], DAYS[3], DAYS[4]
    df = rows(
        "station INT, day DATE, boardings BIGINT, alightings BIGINT",
        [(1, fri, 3, 1), (1, fri, 5, 1), (1, sat, 2, 0), (1, sun, 1, 1), (2, fri, 1, 0)],
    )
    assert rows.of(plans.station_profile(df)) == [
        (1, 10.0, 2.0, 5.0, 11 / 14),
        (2, 1.0, None, None, 1.0),
    ]


def test_one_pass_and_joins_agree(spark):
    from daywise.bindings import events as ev

    for sf in ("0.001", "0.01"):
        tables = [
            plans.daily_condition_table(merged(spark, f"/root/testdata/sf{sf}"), ev.RULES)
            for merged in (ev.merged_in_one_pass, ev.merged_by_joins)
        ]
        a, b = (sorted(map(tuple, t.collect())) for t in tables)
        assert a == b and a
