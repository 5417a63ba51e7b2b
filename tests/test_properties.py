"""Randomised comparisons against brute force on small fixtures."""

import datetime as dt
import random

import pytest
from helpers import page, raw_df, raw_row, reading, uri
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationlake.operators import audit as A
from stationlake.operators import staging as S
from stationlake.operators.windows import plan_chunks

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.date(2026, 1, 25)


def _classify(day, has_data, first, last, bad):
    if has_data and first is not None and day < first:
        return "data_before_first"
    if has_data:
        return "with_data"
    if first is None or day < first:
        return "pre_onboarding"
    if last is not None and day > last:
        return "post_dormancy"
    if bad:
        return "known_bad"
    return "upstream_no_data"


@pytest.mark.parametrize("seed", range(6))
def test_gap_audit_ranges_equal_cells_and_brute_force(spark, seed):
    rnd = random.Random(seed)
    span = (BASE, BASE + dt.timedelta(days=rnd.randint(20, 50)))
    sensors, locs, meas, bad = [], [], [], []
    for sid in range(1, 9):
        loc = sid
        off = lambda: BASE + dt.timedelta(days=rnd.randint(-10, 60))
        first = None if rnd.random() < 0.2 else off()
        last = None if first is None or rnd.random() < 0.2 else off()  # may precede first
        ts = lambda d: None if d is None else dt.datetime.combine(d, dt.time(3))
        locs.append((loc, "AE", ts(first), ts(last)))
        sensors.append((sid, rnd.choice(["pm25", "no2", "so2"]), "µg/m³", loc))
        for _ in range(rnd.randint(0, 25)):
            d = BASE + dt.timedelta(days=rnd.randint(-5, 55))
            meas.append((sid, dt.datetime.combine(d, dt.time(rnd.randint(0, 23))), None))
        if rnd.random() < 0.3:
            bad.append((sid,))
    s_df = spark.createDataFrame(sensors, "sensor_id BIGINT, parameter STRING, unit STRING, location_id BIGINT")
    l_df = spark.createDataFrame(locs, "location_id BIGINT, country_code STRING, datetime_first_utc TIMESTAMP, datetime_last_utc TIMESTAMP")
    m_df = spark.createDataFrame(meas, "sensor_id BIGINT, period_start_utc TIMESTAMP, measurement_value DOUBLE")
    b_df = spark.createDataFrame(bad, "sensor_id BIGINT")
    sp_df = spark.createDataFrame([("AE", span[0], span[1])], "country_code STRING, span_start DATE, span_end DATE")

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    fast = rows(A.gap_audit_by_ranges(s_df, l_df, m_df, b_df, sp_df))
    cells = rows(A.gap_audit(s_df, l_df, m_df, b_df, sp_df))
    assert fast == cells

    # brute force in Python
    data = {(m[0], m[1].date()) for m in meas}
    bad_ids = {b[0] for b in bad}
    loc_of = {l[0]: l for l in locs}
    counts = {}
    for sid, param, _, loc in sensors:
        if param not in ("pm25", "pm10", "no2"):
            continue
        f = loc_of[loc][2].date() if loc_of[loc][2] else None
        la = loc_of[loc][3].date() if loc_of[loc][3] else None
        d = span[0]
        while d <= span[1]:
            key = (param, d.replace(day=1))
            c = _classify(d, (sid, d) in data, f, la, sid in bad_ids)
            counts.setdefault(key, {}).setdefault(c, 0)
            counts[key][c] += 1
            d += dt.timedelta(days=1)
    got = {(r[1], r[2]): r for r in fast}
    assert set(got) == set(counts)
    for key, by_class in counts.items():
        r = got[key]
        assert r[3] == sum(by_class.values())
        for i, name in enumerate(A.GAP_CLASSES):
            assert r[4 + i] == by_class.get(name, 0)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 4), st.floats(0, 100).map(lambda x: round(x, 2))),
                min_size=1, max_size=25))
def test_latest_wins_matches_brute_force(spark, copies):
    # (hour, batch, day-of-object, value): later batch wins, then larger uri, then later record
    rows, by_obj = [], {}
    for hour, batch, obj_day, value in copies:
        by_obj.setdefault((batch, obj_day), []).append((hour, value))
    expected = {}
    for (batch, obj_day), recs in by_obj.items():
        stamp = f"2026-07-{10 + batch:02d} 02:05:00"
        u = uri("AE", f"2026-07-{obj_day + 1:02d}", 5)
        rows.append(raw_row(page(*[reading(v, f"2026-07-01 {h:02d}:00:00") for h, v in recs]), stamp, u))
        for pos, (h, v) in enumerate(recs):
            key = (stamp, u, pos)
            if h not in expected or key > expected[h][0]:
                expected[h] = (key, v)
    got = {r["period_start_utc"].hour: r["measurement_value"] for r in S.stage_measurements(raw_df(spark, rows)).collect()}
    assert got == {h: kv[1] for h, kv in expected.items()}


@SLOW
@given(st.integers(1, 40), st.integers(1, 70))
def test_chunks_tile_the_window(spark, length, n):
    start = dt.date(2026, 1, 1)
    end = start + dt.timedelta(days=length)
    df = spark.createDataFrame([("AE", start, end)], "country_code STRING, window_start DATE, window_end DATE")
    got = [(r["chunk_start"], r["chunk_end"]) for r in plan_chunks(df, n).orderBy("chunk_start").collect()]
    want, cur = [], start
    while cur < end:
        nxt = min(cur + dt.timedelta(days=n), end)
        want.append((cur, nxt))
        cur = nxt
    assert got == want
