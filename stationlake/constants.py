"""Fixed values of the model.

These values must stay exactly as they are for results to match: they are the
guideline table, the fetched parameter set, the gate levels and the path
layout.  They are stated here once, in natural order, and read from here.
"""

from __future__ import annotations

# --- fixed values: pollutants the pipeline fetches and audits --------------
TARGET_PARAMETERS = ("pm25", "pm10", "no2")

# --- fixed values: WHO 2021 guideline table (pollutant, period, value, unit) --
# Also shipped as stationlake/data/thresholds.csv; a test keeps the two equal.
WHO_THRESHOLDS = (
    ("pm25", "annual", 5.0, "µg/m³"),
    ("pm25", "24h", 15.0, "µg/m³"),
    ("pm10", "annual", 15.0, "µg/m³"),
    ("pm10", "24h", 45.0, "µg/m³"),
    ("no2", "annual", 10.0, "µg/m³"),
    ("no2", "24h", 25.0, "µg/m³"),
    ("so2", "24h", 40.0, "µg/m³"),
    ("o3", "peak_season", 60.0, "µg/m³"),
    ("o3", "8h", 100.0, "µg/m³"),
    ("co", "24h", 4.0, "mg/m³"),
)

# --- fixed values: run gates ---------------------------------------------
FAILURE_RATE_THRESHOLD = 0.20  # failed / fetched strictly above this fails
LOOKBACK_DAYS = 7  # each daily run re-fetches the last 7 days
DEFAULT_CHUNK_DAYS = 60  # backfill window width
FRESHNESS_WARN_HOURS = 30
FRESHNESS_ERROR_HOURS = 54

# --- fixed values: raw-zone layout ---------------------------------------
# Objects live at raw/{source}/{COUNTRY}/{partition}/{leaf}.json; the leaf is
# a sensor id or "locations", the partition a day or a backfill window.  The
# source segment names the upstream API; ours is RAW_SOURCE, and identity
# parsing accepts any source segment.
RAW_SOURCE = "airq"
RAW_PREFIX = "raw/" + RAW_SOURCE
LOCATIONS_LEAF = "locations"
SENSOR_ID_PATTERN = r"/(\d+)\.json$"
COUNTRY_PATTERN = r"/raw/[^/]+/([A-Z]{2})/"
BACKFILL_SEGMENT = "backfill"

# Accepted-value lists used by the declarative checks.
SEED_POLLUTANTS = ("pm25", "pm10", "no2", "so2", "o3", "co")
SEED_PERIODS = ("annual", "24h", "8h", "peak_season")
SEED_UNITS = ("µg/m³", "mg/m³")
