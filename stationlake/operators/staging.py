"""Staging: raw pages → typed, deduplicated measurement, location and sensor rows.

Pages are routed by ``source_uri`` (``…/locations.json`` is the inventory;
everything else is a measurement page), records are unnested with ``explode``
(a missing or empty ``results`` array yields no row), and the newest ingested
copy of each key wins.  Each record is parsed on its own, every field as a
string that is cast explicitly: an entry that is no object (a number, a
string, null) is a row of nulls and leaves the page's other records alone.

Ties on ``ingested_at`` (one stamp per load batch) are broken by
``source_uri`` and then by the record's position in its page, newest last, so
the result never depends on the physical order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import country_from_uri, sensor_id_from_uri
from stationlake.operators.dedup import latest_per_key
from stationlake.schemas import (
    ANY_PAGE_DDL,
    LOCATION_RECORD_DDL,
    MEASUREMENT_RECORD_DDL,
    SENSOR_ENTRY_DDL,
)

_LOCATIONS_SUFFIX = "/" + C.LOCATIONS_LEAF + ".json"


def inventory_pages(raw: DataFrame) -> DataFrame:
    """Location inventory pages (``LIKE '%/locations.json'``)."""
    return raw.where(F.col("source_uri").endswith(_LOCATIONS_SUFFIX))


def measurement_pages(raw: DataFrame) -> DataFrame:
    """Everything else (``NOT LIKE``); a null ``source_uri`` is in neither."""
    return raw.where(~F.col("source_uri").endswith(_LOCATIONS_SUFFIX))


def _records(payload: str):
    """``posexplode`` of a page's ``results`` array, each record as JSON text.

    The array is exploded straight from the ``from_json`` expression, not
    from a column holding it: for an exploded *column* the optimizer infers a
    ``size(results) > 0`` filter and pushes it down to the scan, which would
    parse every page twice.
    """
    return F.posexplode(F.from_json(F.col(payload), ANY_PAGE_DDL).getField("results"))


def measurement_records(raw: DataFrame) -> DataFrame:
    """One row per record of every measurement page, identity from the path."""
    return measurement_pages(raw).select(
        sensor_id_from_uri("source_uri").alias("sensor_id"),
        country_from_uri("source_uri").alias("country_code"),
        _records("raw_payload").alias("record_pos", "record"),
        "ingested_at",
        "source_uri",
    ).select(
        "sensor_id", "country_code", "record_pos",
        F.from_json("record", MEASUREMENT_RECORD_DDL).alias("r"),
        "ingested_at", "source_uri",
    )


def parse_measurements(records: DataFrame) -> DataFrame:
    r = F.col("r")
    return records.select(
        "sensor_id",
        "country_code",
        r["parameter"]["name"].alias("parameter"),
        r["parameter"]["units"].alias("unit"),
        r["value"].cast("double").alias("measurement_value"),
        r["period"]["datetimeFrom"]["utc"].cast("timestamp").alias("period_start_utc"),
        r["period"]["datetimeTo"]["utc"].cast("timestamp").alias("period_end_utc"),
        r["period"]["label"].alias("period_label"),
        r["period"]["interval"].alias("period_interval"),
        r["coverage"]["observedCount"].cast("bigint").alias("observed_count"),
        r["coverage"]["percentCoverage"].cast("double").alias("percent_coverage"),
        "ingested_at",
        "source_uri",
        "record_pos",
    )


MEASUREMENT_COLUMNS = [
    "sensor_id",
    "country_code",
    "parameter",
    "unit",
    "measurement_value",
    "period_start_utc",
    "period_end_utc",
    "period_label",
    "period_interval",
    "observed_count",
    "percent_coverage",
    "ingested_at",
    "source_uri",
]

def _newest_first() -> list:
    return [
        F.col("ingested_at").desc_nulls_last(),
        F.col("source_uri").desc_nulls_last(),
        F.col("record_pos").desc(),
    ]


def stage_measurements(raw: DataFrame) -> DataFrame:
    """One row per (sensor_id, period_start_utc): the newest ingested copy."""
    parsed = parse_measurements(measurement_records(raw))
    latest = latest_per_key(parsed, ["sensor_id", "period_start_utc"], _newest_first())
    return latest.select(*MEASUREMENT_COLUMNS)


def location_records(raw: DataFrame) -> DataFrame:
    """One row per location record of every inventory page.

    Both :func:`stage_locations` and :func:`stage_sensors` start here, so a
    caller that needs both can persist this once and parse the pages once.
    """
    return inventory_pages(raw).select(
        _records("raw_payload").alias("record_pos", "record"),
        "ingested_at",
        "source_uri",
    ).select(
        "record_pos", F.from_json("record", LOCATION_RECORD_DDL).alias("r"), "ingested_at", "source_uri"
    )


LOCATION_COLUMNS = [
    "location_id",
    "location_name",
    "locality",
    "country_code",
    "is_reference_monitor",
    "provider_name",
    "latitude",
    "longitude",
    "timezone",
    "datetime_first_utc",
    "datetime_last_utc",
    "ingested_at",
]


def stage_locations(raw: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """One row per location: the newest ingested copy of its metadata."""
    rec = records if records is not None else location_records(raw)
    r = F.col("r")
    parsed = rec.select(
        r["id"].cast("bigint").alias("location_id"),
        r["name"].alias("location_name"),
        r["locality"].alias("locality"),
        r["country"]["code"].alias("country_code"),
        r["isMonitor"].cast("boolean").alias("is_reference_monitor"),
        r["provider"]["name"].alias("provider_name"),
        r["coordinates"]["latitude"].cast("double").alias("latitude"),
        r["coordinates"]["longitude"].cast("double").alias("longitude"),
        r["timezone"].alias("timezone"),
        r["datetimeFirst"]["utc"].cast("timestamp").alias("datetime_first_utc"),
        r["datetimeLast"]["utc"].cast("timestamp").alias("datetime_last_utc"),
        "ingested_at",
        "source_uri",
        "record_pos",
    )
    latest = latest_per_key(parsed, ["location_id"], _newest_first())
    return latest.select(*LOCATION_COLUMNS)


SENSOR_COLUMNS = ["sensor_id", "parameter", "unit", "location_id", "ingested_at"]


def sensor_records(records: DataFrame) -> DataFrame:
    """Second-level unnest: location record → its embedded sensors."""
    r = F.col("r")
    with_sensors = records.select(
        r["id"].cast("bigint").alias("location_id"),
        F.posexplode(r["sensors"]).alias("sensor_pos", "entry"),
        "ingested_at",
        "source_uri",
        "record_pos",
    ).withColumn("s", F.from_json("entry", SENSOR_ENTRY_DDL))
    s = F.col("s")
    return with_sensors.select(
        s["id"].cast("bigint").alias("sensor_id"),
        s["parameter"]["name"].alias("parameter"),
        s["parameter"]["units"].alias("unit"),
        "location_id",
        "ingested_at",
        "source_uri",
        "record_pos",
        "sensor_pos",
    )


def stage_sensors(raw: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """One row per sensor (the sensor → location bridge), newest copy wins."""
    rec = records if records is not None else location_records(raw)
    parsed = sensor_records(rec)
    order = _newest_first() + [F.col("sensor_pos").desc()]
    latest = latest_per_key(parsed, ["sensor_id"], order)
    return latest.select(*SENSOR_COLUMNS)


def target_sensors(raw: DataFrame, targets=C.TARGET_PARAMETERS) -> DataFrame:
    """Distinct (sensor_id, parameter) for target-pollutant sensors, by id.

    A sensor listed twice keeps its last listing (newest page, then last
    position); a sensor whose ``parameter`` is null or not a target is left
    out.
    """
    parsed = sensor_records(location_records(raw)).where(F.col("parameter").isin(*targets))
    order = _newest_first() + [F.col("sensor_pos").desc()]
    latest = latest_per_key(parsed, ["sensor_id"], order)
    return latest.select("sensor_id", "parameter").orderBy("sensor_id")
