"""Threshold flags, rates and the calendar-range rolling mean (T6–T9, T17)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from stationlake.operators import marts as M
from stationlake.sources.seeds import read_thresholds

DAILY = (
    "location_id BIGINT, country_code STRING, parameter STRING, unit STRING, measurement_date DATE, "
    "daily_avg DOUBLE, daily_min DOUBLE, daily_max DOUBLE, reading_count BIGINT, hours_covered BIGINT, "
    "sensor_count BIGINT, is_reference_monitor BOOLEAN"
)


def day(d):
    return dt.date.fromisoformat(d)


def row(loc, param, unit, d, avg, ref=True, country="AE"):
    return (loc, country, param, unit, day(d), avg, avg, avg, 1, 1, 1, ref)


def test_boundary_is_not_an_exceedance(spark):
    daily = spark.createDataFrame([row(1, "pm25", "µg/m³", "2026-07-12", 15.0)], DAILY)
    f = M.threshold_flag_24h(daily, read_thresholds(spark)).first()
    assert f["threshold_24h"] == 15.0 and f["exceeded_24h"] is False
    daily = spark.createDataFrame([row(1, "pm25", "µg/m³", "2026-07-12", 120.9)], DAILY)
    assert M.threshold_flag_24h(daily, read_thresholds(spark)).first()["exceeded_24h"] is True


def test_no_threshold_keeps_row_and_leaves_denominator(spark):
    daily = spark.createDataFrame(
        [
            row(1, "pm25", "ppm", "2026-07-12", 50.0),  # unit differs → no threshold
            row(2, "pm25", "µg/m³", "2026-07-12", 50.0),
            row(3, "pm25", "µg/m³", "2026-07-12", 10.0, ref=False),
        ],
        DAILY,
    )
    out = {r["unit"]: r for r in M.country_compare(daily, read_thresholds(spark)).collect()}
    ppm, ug = out["ppm"], out["µg/m³"]
    assert ppm["threshold_24h"] is None and ppm["locations_with_data"] == 1
    assert ppm["locations_comparable"] == 0 and ppm["locations_exceeding"] == 0
    assert ppm["exceedance_rate"] is None
    assert ug["locations_comparable"] == 2 and ug["locations_exceeding"] == 1
    assert ug["exceedance_rate"] == 50.0 and ug["reference_monitor_locations"] == 1


def test_rolling_mean_uses_calendar_days(spark):
    daily = spark.createDataFrame(
        [
            row(1, "pm25", "µg/m³", "2026-07-01", 1.0),
            row(1, "pm25", "µg/m³", "2026-07-05", 3.0),
            row(1, "pm25", "µg/m³", "2026-07-20", 9.0),
        ],
        DAILY,
    )
    out = M.country_compare(daily, read_thresholds(spark)).orderBy("measurement_date").collect()
    assert [r["rolling_7d_avg"] for r in out] == [1.0, 2.0, 9.0]


def test_two_units_are_peers_in_the_frame(spark):
    daily = spark.createDataFrame(
        [
            row(1, "co", "mg/m³", "2026-07-01", 2.0),
            row(2, "co", "µg/m³", "2026-07-01", 4.0),
        ],
        DAILY,
    )
    out = M.country_compare(daily, read_thresholds(spark)).collect()
    assert len(out) == 2
    assert {r["rolling_7d_avg"] for r in out} == {3.0}


def test_means_are_of_station_day_means(spark):
    daily = spark.createDataFrame(
        [
            (1, "AE", "pm25", "µg/m³", day("2026-07-01"), 10.0, 10.0, 10.0, 24, 24, 1, True),
            (2, "AE", "pm25", "µg/m³", day("2026-07-01"), 20.0, 20.0, 20.0, 1, 1, 1, True),
            (2, "AE", "pm25", "µg/m³", day("2026-07-02"), 30.0, 30.0, 30.0, 1, 1, 1, True),
        ],
        DAILY,
    )
    cc = M.country_compare(daily, read_thresholds(spark)).orderBy("measurement_date").first()
    assert cc["country_daily_avg"] == 15.0 and cc["reading_count"] == 25
    annual = M.annual_compare(daily, read_thresholds(spark)).first()
    assert annual["annual_mean"] == 20.0 and annual["days_with_data"] == 2
    assert annual["locations_with_data"] == 2 and annual["threshold_annual"] == 5.0
    assert annual["exceeds_annual"] is True and annual["measurement_year"] == 2026


def test_rounding_midpoint_is_stable(spark):
    from stationlake.functions.columns import stable_round

    mid = 38.3716875
    below = math.nextafter(mid, 0.0)
    df = spark.createDataFrame([(mid,), (below,)], "x DOUBLE")
    vals = [r[0] for r in df.select(stable_round(F.col("x"), 6)).collect()]
    assert vals[0] == vals[1] == 38.371688
