"""Incremental update of touched days equals a full rebuild and leaves other days alone."""

import glob
import os
import random

import pytest

from helpers import location, page, raw_df, raw_row, reading, uri

from stationlake.operators import daily as D
from stationlake.operators import staging as S
from stationlake.plans import incremental as IN
from stationlake.sources import pages as P


def _start(spark, tmp_dir, extra=()):
    inv = raw_row(page(location(1, "AE", [(11, "pm25")]), location(2, "AE", [(12, "pm25")], is_monitor=False)),
                  "2026-07-01 00:00:00", uri("AE", "2026-07-01", "locations"))
    days = [raw_row(page(reading(10.0 * d, f"2026-07-0{d} 01:00:00")), f"2026-07-0{d + 1} 02:05:00", uri("AE", f"2026-07-0{d}", 11))
            for d in (1, 2)]
    raw_path, path = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "days")
    P.append_batch(raw_df(spark, [inv, *days, *extra]), raw_path)
    IN.build_sensor_days(P.read_raw(spark, raw_path), path)
    return raw_path, path


def _both(spark, raw_path, path):
    """Station-days as stored and as a full rebuild gives them."""
    raw = P.read_raw(spark, raw_path)
    sensors, locs = S.stage_sensors(raw), S.stage_locations(raw)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    return key(IN.read_daily(spark, path, sensors, locs)), key(D.daily_station_agg(S.stage_measurements(raw), sensors, locs))


def test_only_touched_days_are_rewritten(spark, tmp_dir):
    raw_path, path = _start(spark, tmp_dir)
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/measurement_date=2026-07-01/*.parquet")}
    before = files()
    fix = raw_row(page(reading(22.0, "2026-07-02 01:00:00"), reading(30.0, "2026-07-03 05:00:00")),
                  "2026-07-04 02:05:00", uri("AE", "2026-07-03", 11))
    P.append_batch(raw_df(spark, [fix]), raw_path)
    days = IN.update_sensor_days(spark, P.read_raw(spark, raw_path), "2026-07-04 00:00:00", path)
    assert sorted(r[0].isoformat() for r in days.collect()) == ["2026-07-02", "2026-07-03"]
    stored, full = _both(spark, raw_path, path)
    assert stored == full and [r[5] for r in sorted(stored, key=lambda r: r[4])] == [10.0, 22.0, 30.0]
    assert before == files()


def test_withdrawn_day_disappears(spark, tmp_dir):
    raw_path, path = _start(spark, tmp_dir)
    gone = raw_row(page(reading(None, "2026-07-02 01:00:00")), "2026-07-04 02:05:00", uri("AE", "2026-07-03", 11))
    P.append_batch(raw_df(spark, [gone]), raw_path)
    IN.update_sensor_days(spark, P.read_raw(spark, raw_path), "2026-07-04 00:00:00", path)
    stored, full = _both(spark, raw_path, path)
    assert stored == full and [r[4].isoformat() for r in stored] == ["2026-07-01"]


def test_a_moved_sensor_and_a_flipped_flag_apply_to_untouched_days(spark, tmp_dir):
    raw_path, path = _start(spark, tmp_dir)
    moved = raw_row(page(location(1, "AE", []), location(2, "AE", [(11, "pm25"), (12, "pm25")], is_monitor=True)),
                    "2026-07-05 00:00:00", uri("AE", "2026-07-05", "locations"))
    new = raw_row(page(reading(5.0, "2026-07-04 01:00:00")), "2026-07-05 02:05:00", uri("AE", "2026-07-04", 11))
    P.append_batch(raw_df(spark, [moved, new]), raw_path)
    IN.update_sensor_days(spark, P.read_raw(spark, raw_path), "2026-07-05 00:00:00", path)
    stored, full = _both(spark, raw_path, path)
    assert stored == full and {r[0] for r in stored} == {2} and len(stored) == 3


def test_a_table_without_any_reading_can_be_read_and_updated(spark, tmp_dir):
    raw_path, path = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "days")
    P.ensure_raw_table(spark, raw_path)
    IN.build_sensor_days(P.read_raw(spark, raw_path), path)
    IN.update_sensor_days(spark, P.read_raw(spark, raw_path), "2026-07-05 00:00:00", path)
    assert IN.read_sensor_days(spark, path).count() == 0


def test_days_are_written_by_few_files(spark, tmp_dir):
    many = [raw_row(page(reading(float(s), "2026-07-01 03:00:00")), "2026-07-02 02:05:00", uri("AE", "2026-07-01", 100 + s)) for s in range(40)]
    _, path = _start(spark, tmp_dir, many)
    assert len(glob.glob(f"{path}/measurement_date=2026-07-01/*.parquet")) == 1


def test_a_reading_landed_before_its_day_stays(spark, tmp_dir):
    """A clock that runs ahead: the reading of the 16th came on the 15th, the next load brings another sensor's."""
    early = raw_row(page(reading(7.0, "2026-07-16 00:00:00")), "2026-07-15 23:58:00", uri("AE", "2026-07-15", 11))
    raw_path, path = _start(spark, tmp_dir, [early])
    other = raw_row(page(reading(9.0, "2026-07-16 03:00:00")), "2026-07-17 02:05:00", uri("AE", "2026-07-16", 12))
    P.append_batch(raw_df(spark, [other]), raw_path)
    IN.update_sensor_days(spark, P.read_raw(spark, raw_path), "2026-07-17 00:00:00", path)
    stored, full = _both(spark, raw_path, path)
    assert stored == full and sum(r[4].day == 16 for r in stored) == 2


@pytest.mark.parametrize("seed", range(2))
def test_updates_equal_a_rebuild_whatever_the_stamps(spark, tmp_dir, seed):
    rng = random.Random(seed)
    raw_path, path = _start(spark, tmp_dir)
    since = "2026-07-05 00:00:00"
    for load in range(3):
        rows = []
        for _ in range(12):
            day = rng.randrange(1, 29)  # before, at and long after its landing
            at = f"2026-07-{5 + 6 * load + rng.randrange(6):02d} {rng.randrange(24):02d}:05:00"
            value = rng.choice((None, float(rng.randrange(100))))
            rows.append(raw_row(page(reading(value, f"2026-07-{day:02d} {rng.randrange(4):02d}:00:00")), at, uri("AE", "2026-07-01", rng.choice((11, 12)))))
        P.append_batch(raw_df(spark, rows), raw_path)
        IN.update_sensor_days(spark, P.read_raw(spark, raw_path), since, path)
        since = f"2026-07-{5 + 6 * (load + 1):02d} 00:00:00"
        stored, full = _both(spark, raw_path, path)
        assert stored == full


def test_an_update_reads_the_ingest_days_of_touched_days_only(spark, tmp_dir, monkeypatch):
    raw_path, path = _start(spark, tmp_dir)
    fix = raw_row(page(reading(22.0, "2026-07-02 01:00:00")), "2026-07-09 02:05:00", uri("AE", "2026-07-08", 11))
    P.append_batch(raw_df(spark, [fix]), raw_path)
    staged = []
    real = S.stage_measurements
    monkeypatch.setattr(IN.S, "stage_measurements", lambda pages: staged.append(pages) or real(pages))
    IN.update_sensor_days(spark, P.read_raw(spark, raw_path), "2026-07-09 00:00:00", path)
    assert sorted(r[0].isoformat() for r in staged[0].select("ingest_date").distinct().collect()) == ["2026-07-03", "2026-07-09"]
