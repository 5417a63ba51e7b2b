"""Station-day aggregate: grain (location, parameter, UTC day).

Built in two steps.  The sensor-day table holds what the readings say, without
any dimension: sum, count, extremes and the hours seen as bits of a mask.  The
roll-up joins the current station metadata, so a change of a sensor's station
or of a monitor flag applies to all history without touching the sensor-days.

Completeness is carried as columns (``reading_count``, ``hours_covered``),
never used as a filter.  Valueless records count for nothing; a sensor-day of
valueless records only stays in the sensor-day table (with count 0) and is
left out of the roll-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAILY_KEYS = [
    "location_id",
    "country_code",
    "parameter",
    "unit",
    "measurement_date",
    "is_reference_monitor",
]

DAILY_COLUMNS = [
    "location_id",
    "country_code",
    "parameter",
    "unit",
    "measurement_date",
    "daily_avg",
    "daily_min",
    "daily_max",
    "reading_count",
    "hours_covered",
    "sensor_count",
    "is_reference_monitor",
]


def sensor_dimension(sensors: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per sensor with its station's country and monitor flag."""
    s = sensors.select("sensor_id", "location_id")
    loc = locations.select("location_id", "country_code", "is_reference_monitor")
    return s.join(loc, "location_id")


def sensor_day_agg(measurements: DataFrame) -> DataFrame:
    """One row per (sensor, parameter, unit, UTC day); all parts are mergeable and partially aggregated."""
    v = F.col("measurement_value")
    hour_bit = F.when(v.isNotNull(), F.expr("shiftleft(1, hour(period_start_utc))"))
    return measurements.groupBy(
        "sensor_id", "parameter", "unit", F.to_date("period_start_utc").alias("measurement_date")
    ).agg(
        F.sum(v).alias("value_sum"),
        F.min(v).alias("value_min"),
        F.max(v).alias("value_max"),
        F.count(v).alias("reading_count"),
        F.coalesce(F.bit_or(hour_bit), F.lit(0)).alias("hour_mask"),
    )


def roll_up(sensor_days: DataFrame, sensors: DataFrame, locations: DataFrame) -> DataFrame:
    """Sensor-days to station-days under the current metadata.

    A sensor has one row per group, so counting rows counts sensors, and the
    hours of a station are the bits of its sensors' masks together: no
    distinct aggregate, so no Expand of the facts.  The dimension tables are
    joined first.  No side of the join with the days is broadcast: by the size
    of their files stored days would be, and go through the driver whole.  A
    sensor has one row in the dimension, so a task's hash table holds its share.
    """
    days = sensor_days.where("reading_count > 0")
    joined = days.join(sensor_dimension(sensors, locations).hint("shuffle_hash"), "sensor_id")
    agg = joined.groupBy(*DAILY_KEYS).agg(
        (F.sum("value_sum") / F.sum("reading_count")).alias("daily_avg"),
        F.min("value_min").alias("daily_min"),
        F.max("value_max").alias("daily_max"),
        F.sum("reading_count").cast("bigint").alias("reading_count"),
        F.bit_count(F.bit_or("hour_mask")).cast("bigint").alias("hours_covered"),
        F.count(F.lit(1)).alias("sensor_count"),
    )
    return agg.select(*DAILY_COLUMNS)


def daily_station_agg(measurements: DataFrame, sensors: DataFrame, locations: DataFrame) -> DataFrame:
    return roll_up(sensor_day_agg(measurements), sensors, locations)
