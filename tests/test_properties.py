"""Random inputs against plain Python."""

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daywise import operators as op, plans

DAYS = [datetime.date(2025, 1, d) for d in range(1, 9)]
day = st.sampled_from(DAYS)
few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

trips = st.lists(st.tuples(day, st.integers(0, 99), st.integers(0, 99)), max_size=25)
readings = st.dictionaries(
    st.tuples(day, st.sampled_from([108, 90])),
    st.tuples(
        st.sampled_from([None, -9.0, 0.0, 0.1, 19.9, 20.0, 80.0]),
        st.sampled_from([None, 34.9, 35.0]),
        st.sampled_from([None, -15.0, -14.9]),
    ),
)
grains = st.lists(st.tuples(day, st.just(1), st.sampled_from([None, 0, 30, 31, 80, 150, 300])), max_size=25)


def totals(rows):
    out = {}
    for d, a, b in rows:
        out[d] = out.get(d, 0) + a + b
    return out


def table(bus, subway, weather, dust):
    a, b = totals(bus), totals(subway)
    out = []
    for (d, station), (rain, hi, lo) in weather.items():
        if station != 108 or d not in a or d not in b:
            continue
        rain = 0.0 if rain is None else rain
        pm = [v for x, _, v in dust if x == d and v is not None]
        mean = sum(pm) / len(pm) if pm else None
        grade = "unknown" if mean is None else (
            "good" if mean <= 30 else "normal" if mean <= 80 else "bad" if mean <= 150 else "very bad"
        )
        severe = "heatwave" if hi and hi >= 35 else "coldwave" if lo and lo <= -15 else "normal"
        out.append((
            d, rain, "heavy" if rain >= 20 else "light" if rain > 0 else "none", a[d], b[d], mean,
            grade, severe, "weekend" if d.weekday() >= 5 else "weekday", d.strftime("%Y%m"),
        ))
    return sorted(out, key=str)


@few
@given(bus=trips, subway=trips, weather=readings, dust=grains)
def test_daily_table(spark, rows, bus, subway, weather, dust):
    usage = "day DATE, boardings BIGINT, alightings BIGINT"
    merged = plans.merge_inputs(
        rows(usage, bus),
        rows(usage, subway),
        rows("day DATE, station INT, rain DOUBLE, tmax DOUBLE, tmin DOUBLE", [(*k, *v) for k, v in weather.items()]),
        rows("day DATE, station INT, pm INT", dust),
        108,
    )
    assert rows.of(plans.daily_condition_table(merged)) == table(bus, subway, weather, dust)


@few
@given(st.lists(st.tuples(st.sampled_from("pq"), st.integers(-1000, 1000)), min_size=1, max_size=40))
def test_box_lies_within_data(rows, data):
    for r in op.box_stats(rows("c STRING, x BIGINT", data), ["c"], "x").collect():
        x = sorted(v for c, v in data if c == r.c)
        assert r.n == len(x)
        assert x[0] <= r.q1 <= r.median <= r.q3 <= x[-1]
        assert r.whisker_lo in x and r.whisker_hi in x
        outside = [v for v in x if v < r.whisker_lo or v > r.whisker_hi]
        assert r.n_outliers == len(outside)
