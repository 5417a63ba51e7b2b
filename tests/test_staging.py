"""Staging semantics on literal pages."""

import json

from helpers import location, page, raw_df, raw_row, reading, uri
from pyspark.sql import functions as F

from stationlake.operators import daily as D
from stationlake.operators import staging as S


def inventory(spark, stamp="2026-07-12 02:05:00"):
    body = page(location(1, "AE", [(11, "pm25"), (12, "temperature")]), location(2, "AE", [(13, "no2")]))
    return raw_row(body, stamp, uri("AE", "2026-07-12", "locations"))


def test_quoted_number_and_missing_results(spark):
    rows = [
        raw_row('{"results": [{"value": "7", "period": {"datetimeFrom": {"utc": "2026-07-12T01:00:00Z"}}}]}',
                "2026-07-13 02:05:00", uri("AE", "2026-07-12", 11)),
        raw_row("{}", "2026-07-13 02:05:00", uri("AE", "2026-07-12", 12)),
        raw_row('{"results": []}', "2026-07-13 02:05:00", uri("AE", "2026-07-12", 13)),
    ]
    out = S.stage_measurements(raw_df(spark, rows)).collect()
    assert len(out) == 1
    assert out[0]["measurement_value"] == 7.0 and out[0]["sensor_id"] == 11
    assert out[0]["country_code"] == "AE"


def test_path_without_id_gives_null_not_error(spark):
    df = spark.createDataFrame([(uri("AE", "2026-07-12", "locations"),), ("no/match/here",)], "u STRING")
    from stationlake.functions.columns import country_from_uri, sensor_id_from_uri

    got = df.select(sensor_id_from_uri("u").alias("s"), country_from_uri("u").alias("c")).collect()
    assert got[0]["s"] is None and got[0]["c"] == "AE"
    assert got[1]["s"] is None and got[1]["c"] is None


def test_late_correction_wins(spark):
    first = page(reading(10.0, "2026-07-06 05:00:00"))
    later = page(reading(12.5, "2026-07-06 05:00:00"))
    rows = [
        raw_row(first, "2026-07-07 02:05:00", uri("AE", "2026-07-06", 11)),
        raw_row(later, "2026-07-12 02:05:00", uri("AE", "2026-07-11", 11)),
    ]
    out = S.stage_measurements(raw_df(spark, rows)).collect()
    assert len(out) == 1 and out[0]["measurement_value"] == 12.5


def test_equal_stamps_larger_uri_wins(spark):
    a = page(reading(1.0, "2026-07-06 05:00:00"))
    b = page(reading(2.0, "2026-07-06 05:00:00"))
    rows = [
        raw_row(a, "2026-07-07 02:05:00", uri("AE", "2026-07-06", 11)),
        raw_row(b, "2026-07-07 02:05:00", uri("AE", "2026-07-07", 11)),
    ]
    out = S.stage_measurements(raw_df(spark, rows)).collect()
    assert out[0]["measurement_value"] == 2.0


def test_equal_stamp_same_page_last_record_wins(spark):
    body = page(reading(1.0, "2026-07-06 05:00:00"), reading(3.0, "2026-07-06 05:00:00"))
    out = S.stage_measurements(raw_df(spark, [raw_row(body, "2026-07-07 02:05:00", uri("AE", "2026-07-06", 11))])).collect()
    assert [r["measurement_value"] for r in out] == [3.0]


def test_doubled_batch_dedups_to_half(spark):
    bodies = [page(reading(float(h), f"2026-07-14 {h:02d}:00:00")) for h in range(24)]
    rows = []
    for stamp in ("2026-07-15 02:05:00", "2026-07-15 09:00:00"):
        rows += [raw_row(b, stamp, uri("PK", "2026-07-14", 42)) for b in bodies]
    out = S.stage_measurements(raw_df(spark, rows))
    assert out.count() == 24
    assert out.agg(F.max("ingested_at")).first()[0].hour == 9


def test_null_value_staged_but_not_in_daily(spark):
    body = page(reading(None, "2026-07-12 01:00:00"), reading(20.0, "2026-07-12 02:00:00"))
    rows = [raw_row(body, "2026-07-13 02:05:00", uri("AE", "2026-07-12", 11)), inventory(spark)]
    raw = raw_df(spark, rows)
    meas = S.stage_measurements(raw)
    assert meas.count() == 2
    daily = D.daily_station_agg(meas, S.stage_sensors(raw), S.stage_locations(raw)).collect()
    assert len(daily) == 1
    d = daily[0]
    assert d["reading_count"] == 1 and d["daily_avg"] == 20.0 and d["hours_covered"] == 1
    assert d["location_id"] == 1 and d["is_reference_monitor"] is True


def test_inventory_staging_two_levels(spark):
    raw = raw_df(spark, [inventory(spark), inventory(spark, "2026-07-13 02:05:00")])
    sensors = {r["sensor_id"]: r for r in S.stage_sensors(raw).collect()}
    assert set(sensors) == {11, 12, 13}
    assert sensors[13]["location_id"] == 2
    assert sensors[11]["ingested_at"].day == 13
    locs = S.stage_locations(raw).collect()
    assert sorted(r["location_id"] for r in locs) == [1, 2]


def test_target_sensor_extraction(spark):
    p1 = page(location(1, "PK", [(310, "pm10"), (88, None), (41, "so2")]), location(2, "PK", [(52, "pm25")]))
    p2 = page(location(3, "PK", [(310, "no2"), (64, "humidity"), (17, "no2")]))
    rows = [
        raw_row(p1, "2026-07-12 02:05:00", uri("PK", "2026-07-12", "locations")),
        raw_row(p2, "2026-07-13 02:05:00", uri("PK", "2026-07-13", "locations")),
    ]
    got = [(r["sensor_id"], r["parameter"]) for r in S.target_sensors(raw_df(spark, rows)).collect()]
    assert got == [(17, "no2"), (52, "pm25"), (310, "no2")]  # 310: its newest listing


def test_an_odd_entry_leaves_the_other_records_of_a_page(spark):
    good = json.dumps(reading(3.0, "2026-07-12 01:00:00"))
    body = '{"results": [5, %s, "text", null, [1], {"value": "7", "parameter": 3}]}' % good
    raw = raw_df(spark, [raw_row(body, "2026-07-13 02:05:00", uri("AE", "2026-07-12", 11))])
    recs = S.parse_measurements(S.measurement_records(raw)).orderBy("record_pos").collect()
    assert [r["measurement_value"] for r in recs] == [None, 3.0, None, None, None, 7.0]
    assert recs[1]["parameter"] == "pm25" and recs[5]["parameter"] is None


def test_an_odd_entry_leaves_the_other_stations_and_sensors(spark):
    station = location(1, "AE", [(11, "pm25"), (12, "no2")])
    station["sensors"][1:1] = [3, None, "x"]
    raw = raw_df(spark, [raw_row(json.dumps({"results": [17, station]}), "2026-07-13 02:05:00", uri("AE", "2026-07-12", "locations"))])
    assert {r["sensor_id"] for r in S.stage_sensors(raw).collect()} >= {11, 12}
    assert 1 in {r["location_id"] for r in S.stage_locations(raw).collect()}
    assert [r["sensor_id"] for r in S.target_sensors(raw).collect()] == [11, 12]


def test_hours_covered_counts_distinct_hours(spark):
    body = page(
        reading(1.0, "2026-07-12 01:00:00"),
        reading(2.0, "2026-07-12 01:30:00"),
        reading(3.0, "2026-07-12 23:00:00"),
    )
    raw = raw_df(spark, [raw_row(body, "2026-07-13 02:05:00", uri("AE", "2026-07-12", 11)), inventory(spark)])
    d = D.daily_station_agg(S.stage_measurements(raw), S.stage_sensors(raw), S.stage_locations(raw)).first()
    assert d["reading_count"] == 3 and d["hours_covered"] == 2 and d["sensor_count"] == 1


def test_rerun_leaves_staged_values_unchanged(spark):
    bodies = [page(reading(float(h) + 0.5, f"2026-07-14 {h:02d}:00:00"), reading(float(h), f"2026-07-14 {h:02d}:30:00"))
              for h in range(6)]
    once = [raw_row(b, "2026-07-15 02:05:00", uri("PK", "2026-07-14", 42)) for b in bodies]
    twice = once + [raw_row(b, "2026-07-15 09:00:00", uri("PK", "2026-07-14", 42)) for b in bodies]
    cols = [c for c in S.MEASUREMENT_COLUMNS if c != "ingested_at"]
    a = S.stage_measurements(raw_df(spark, once)).select(*cols)
    b = S.stage_measurements(raw_df(spark, twice)).select(*cols)
    assert a.count() == b.count() == 12
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
