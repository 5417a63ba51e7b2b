"""Scale helpers: zone-free literals, no driver-side size checks."""

import datetime as dt

from stationlake.functions.columns import ts_lit


def test_ts_lit_keeps_wall_clock_in_session_zone(spark):
    v = spark.range(1).select(
        ts_lit(dt.datetime(2026, 7, 12, 2, 5)).cast("string").alias("a"),
        ts_lit("2026-07-12 02:05:00").cast("string").alias("b"),
    ).first()
    assert v["a"] == v["b"] == "2026-07-12 02:05:00"
