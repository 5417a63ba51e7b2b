"""Gap audit classes in their fixed order (T11, T12)."""

import datetime as dt

from stationlake.operators import audit as A

SENSORS = "sensor_id BIGINT, parameter STRING, unit STRING, location_id BIGINT"
LOCS = "location_id BIGINT, country_code STRING, datetime_first_utc TIMESTAMP, datetime_last_utc TIMESTAMP"
MEAS = "sensor_id BIGINT, period_start_utc TIMESTAMP, measurement_value DOUBLE"
BAD = "sensor_id BIGINT"
SPANS = "country_code STRING, span_start DATE, span_end DATE"


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_every_class_and_null_first_day(spark):
    sensors = spark.createDataFrame(
        [(1, "pm25", "µg/m³", 10), (2, "pm25", "µg/m³", 20), (3, "pm10", "µg/m³", 10), (4, "temperature", "c", 10)],
        SENSORS,
    )
    locs = spark.createDataFrame(
        [(10, "AE", ts("2026-07-03 08:00:00"), ts("2026-07-05 10:00:00")), (20, "AE", None, None)], LOCS
    )
    meas = spark.createDataFrame(
        [
            (1, ts("2026-07-02 01:00:00"), 1.0),  # before first day → data_before_first
            (1, ts("2026-07-04 01:00:00"), None),  # valueless still counts as data
            (2, ts("2026-07-03 01:00:00"), 2.0),  # null first day with data → with_data
        ],
        MEAS,
    )
    bad = spark.createDataFrame([(3,)], BAD)
    spans = spark.createDataFrame([("AE", dt.date(2026, 7, 1), dt.date(2026, 7, 6))], SPANS)
    expected = A.expected_sensor_days(sensors, locs, spans)
    assert expected.count() == 3 * 6  # temperature sensor is not audited
    classified = A.gap_classify(expected, A.actual_sensor_days(meas), bad)
    got = {(r["sensor_id"], r["expected_day"].day): r["gap_class"] for r in classified.collect()}
    assert got[(1, 1)] == "pre_onboarding"
    assert got[(1, 2)] == "data_before_first"
    assert got[(1, 3)] == "upstream_no_data"
    assert got[(1, 4)] == "with_data"
    assert got[(1, 6)] == "post_dormancy"
    assert got[(2, 3)] == "with_data"
    assert got[(2, 4)] == "pre_onboarding"
    assert got[(3, 4)] == "known_bad"
    assert got[(3, 6)] == "post_dormancy"
    monthly = A.gap_audit_monthly(classified).collect()
    total = sum(r["expected_sensor_days"] for r in monthly)
    parts = sum(sum(r[c] for c in A.GAP_CLASSES) for r in monthly)
    assert total == parts == 18
    pm25 = [r for r in monthly if r["parameter"] == "pm25"][0]
    assert pm25["audit_month"] == dt.date(2026, 7, 1)
    assert pm25["coverage_pct"] == round(2 / 12 * 100, 1)


def test_spine_includes_both_ends(spark):
    spans = spark.createDataFrame([("AE", dt.date(2024, 7, 1), dt.date(2026, 7, 17))], SPANS)
    assert A.calendar_spine(spans).count() == 747
