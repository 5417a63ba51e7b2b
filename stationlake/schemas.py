"""Declared schemas.  Nothing in the model is inferred.

Page payloads are read schema-on-read: every scalar leaf is declared STRING and
cast explicitly afterwards, so a quoted number (``"7"``) and a bare number
(``7``) parse the same way and a malformed one fails the cast instead of
silently turning into null.
"""

from __future__ import annotations

# Raw landing table: one row per verbatim API page.
RAW_PAGES_DDL = (
    "raw_payload STRING, ingested_at TIMESTAMP, source_uri STRING, ingest_date DATE"
)

# One record of a measurement page, as read by staging.
MEASUREMENT_RECORD_DDL = (
    "value STRING, "
    "parameter STRUCT<name: STRING, units: STRING>, "
    "period STRUCT<label: STRING, interval: STRING, "
    "datetimeFrom: STRUCT<utc: STRING>, datetimeTo: STRUCT<utc: STRING>>, "
    "coverage STRUCT<observedCount: STRING, percentCoverage: STRING>"
)

# One record of a location inventory page; its sensors are parsed one by one.
LOCATION_RECORD_DDL = (
    "id STRING, name STRING, locality STRING, "
    "country STRUCT<code: STRING>, isMonitor STRING, "
    "provider STRUCT<name: STRING>, "
    "coordinates STRUCT<latitude: STRING, longitude: STRING>, "
    "timezone STRING, "
    "datetimeFirst STRUCT<utc: STRING>, datetimeLast STRUCT<utc: STRING>, "
    "sensors ARRAY<STRING>"
)

# One sensor listed in a location record.
SENSOR_ENTRY_DDL = "id STRING, parameter STRUCT<name: STRING, units: STRING>"

# Any page: the record array, each record as its JSON text.
ANY_PAGE_DDL = "results ARRAY<STRING>"

# Sensor-days, partitioned by measurement_date.
SENSOR_DAY_DDL = (
    "sensor_id BIGINT, parameter STRING, unit STRING, value_sum DOUBLE, value_min DOUBLE, "
    "value_max DOUBLE, reading_count BIGINT, hour_mask INT, measurement_date DATE"
)

THRESHOLDS_DDL = (
    "pollutant STRING, averaging_period STRING, threshold_value DOUBLE, unit STRING"
)

KNOWN_BAD_DDL = (
    "sensor_id BIGINT, country_code STRING, first_seen_failing DATE, "
    "last_verified_failing DATE, note STRING"
)

FETCH_LOG_DDL = (
    "country_code STRING, sensor_id BIGINT, parameter STRING, status STRING, "
    "measurements BIGINT, uri STRING, error STRING"
)

MANIFEST_DDL = (
    "country STRING, window_start DATE, window_end DATE, measurements BIGINT, "
    "sensors_with_data BIGINT, sensors_empty BIGINT, sensors_failed BIGINT, "
    "completed_at TIMESTAMP"
)

# Failed sensor ids of completed windows, one row each (child of the manifest).
MANIFEST_FAILED_DDL = (
    "country STRING, window_start DATE, window_end DATE, sensor_id BIGINT, completed_at TIMESTAMP"
)

DQ_REPORT_DDL = (
    "run_id STRING, table_name STRING, check_name STRING, column_name STRING, "
    "severity STRING, failures BIGINT, status STRING"
)
