"""Chunk planning, labels, half-open windows and lookback."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationlake.operators.windows import half_open_filter, lookback_bounds, plan_chunks

W = "country_code STRING, window_start DATE, window_end DATE"


def d(s):
    return dt.date.fromisoformat(s)


def chunks(spark, start, end, n):
    df = spark.createDataFrame([("AE", d(start), d(end))], W)
    return [(r["chunk_start"].isoformat(), r["chunk_end"].isoformat())
            for r in plan_chunks(df, n).orderBy("chunk_start").collect()]


def test_tiles_abut_and_last_is_truncated(spark):
    # eleven days: two whole weeks don't fit, four-day tiles leave three days over
    assert chunks(spark, "2025-03-27", "2025-04-07", 7) == [("2025-03-27", "2025-04-03"), ("2025-04-03", "2025-04-07")]
    assert chunks(spark, "2025-03-27", "2025-04-07", 4) == [
        ("2025-03-27", "2025-03-31"), ("2025-03-31", "2025-04-04"), ("2025-04-04", "2025-04-07")]
    assert chunks(spark, "2025-03-27", "2025-04-07", 90) == [("2025-03-27", "2025-04-07")]


@pytest.mark.parametrize("start,end,n", [("2025-04-07", "2025-04-07", 3), ("2025-04-07", "2025-03-27", 3), ("2025-03-27", "2025-04-07", -1)])
def test_bad_windows_fail(spark, start, end, n):
    with pytest.raises(Exception):
        chunks(spark, start, end, n)


def test_label_of_a_chunk_across_a_leap_day(spark):
    df = spark.createDataFrame([("AE", d("2024-02-20"), d("2024-03-20"))], W)
    assert plan_chunks(df, 10).orderBy("chunk_start").first()["chunk_label"] == "backfill/2024-02-20_2024-03-01"


def test_half_open_and_lookback(spark):
    df = spark.createDataFrame([(d("2031-03-02"),), (d("2031-03-03"),), (d("2031-03-09"),), (d("2031-03-10"),)], "day DATE")
    lo, hi = lookback_bounds(F.lit(d("2031-03-09")), 7)
    got = [r["day"].isoformat() for r in half_open_filter(df, "day", lo, hi).orderBy("day").collect()]
    assert got == ["2031-03-03", "2031-03-09"]
    bounds = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (bounds["lo"], bounds["hi"]) == (d("2031-03-03"), d("2031-03-10"))


def test_object_names_for_days_and_windows(spark):
    from stationlake import constants as C
    from stationlake.functions.columns import chunk_label, day_segment, object_name

    df = spark.createDataFrame(
        [("NO", d("2031-03-09"), d("2031-03-09"), "771"), ("se", d("2030-02-11"), d("2030-04-12"), "locations")],
        "cc STRING, s DATE, e DATE, leaf STRING",
    )
    got = df.select(
        object_name("cc", day_segment("s"), "leaf").alias("daily"),
        object_name("cc", chunk_label("s", "e"), "leaf").alias("window"),
    ).collect()
    prefix = C.RAW_PREFIX
    assert got[0]["daily"] == f"{prefix}/NO/2031-03-09/771.json"
    assert got[1]["daily"] == f"{prefix}/SE/2030-02-11/locations.json"
    assert got[1]["window"] == f"{prefix}/SE/backfill/2030-02-11_2030-04-12/locations.json"
