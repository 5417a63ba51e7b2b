"""How the driver's test tables stand in for the model's inputs.

The model's input is a raw page table of verbatim API pages.  The driver ships
TPC-H-like tables instead; this module derives model inputs from them with
Spark, so the work of every query grows with those tables:

* ``events`` become measurement readings: ``user_id`` is the sensor, the hour
  of ``ts`` the measurement period, ``ts`` the landing stamp, ``event_type``
  the pollutant, ``value`` the reading and ``props.k`` the observed count; a
  reading with an observed count of 0 carries no value.  Each reading is
  landed as its own one-record page at ``raw/{source}/{CC}/{day}/{sensor}.json``.
* ``nation`` rows are stations (locations), their ``region`` the country
  (code = first two letters of the region name); ``customer`` rows are the
  sensors of the station ``c_nationkey``, with the pollutant picked by
  ``c_mktsegment``.  Inventory pages list each station with its sensors in
  slices of at most 1,000, so no page grows with the data.
* A station's activity range (``datetimeFirst``/``datetimeLast``) is one day
  inside its observed first and last reading; stations of the region with key
  4 publish no activity range.  A sensor with a negative account balance is on
  the known-bad list.
* ``lineitem`` is a seven-year reading history: supplier = sensor, the
  supplier's nation = station, ``l_returnflag`` = pollutant,
  ``l_quantity`` = value, ``l_shipdate`` = period start.

Every mapping below is a fixed value; ``__spark_entry__.oracle_sql`` states
the same mapping in SQL over the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import day_segment, iso_utc, object_name, ts_lit

# --- fixed values: driver-table mapping -------------------------------------
EVENT_TYPE_POLLUTANT = {
    "view": "pm25",
    "click": "pm10",
    "purchase": "no2",
    "signup": "o3",
    "error": "co",
}
SEGMENT_POLLUTANT = {
    "MACHINERY": "pm25",
    "BUILDING": "pm10",
    "AUTOMOBILE": "no2",
    "HOUSEHOLD": "so2",
    "FURNITURE": "o3",
}
RETURNFLAG_POLLUTANT = {"A": "pm25", "N": "pm10", "R": "no2"}
MASS_UNIT_POLLUTANTS = ("co",)  # reported in mg/m³, all others in µg/m³
NO_ACTIVITY_RANGE_REGION = 4
SENSORS_PER_INVENTORY_PAGE = 1000
LANDING_ROOT = "lake://landing"
INVENTORY_STAMP = dt.datetime(2024, 2, 1, 2, 5, 0)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """CASE expression over a fixed mapping (null for unknown keys)."""
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out


def unit_for(pollutant: Column) -> Column:
    return F.when(pollutant.isin(*MASS_UNIT_POLLUTANTS), F.lit("mg/m³")).otherwise(
        F.lit("µg/m³")
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station: nation ⋈ region (both bounded by the TPC-H spec)."""
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    return nation.join(
        F.broadcast(region), nation.n_regionkey == region.r_regionkey
    ).select(
        F.col("n_nationkey").cast("bigint").alias("location_id"),
        F.col("n_name").alias("location_name"),
        F.col("r_name").alias("locality"),
        F.upper(F.substring("r_name", 1, 2)).alias("country_code"),
        (F.col("n_nationkey") % 3 == 0).alias("is_monitor"),
        F.col("r_regionkey").alias("region_key"),
    )


def sensor_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sensor_id → (location_id, country_code) for every customer."""
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    st = stations(spark, sf_dir).select("location_id", "country_code")
    return customer.join(
        F.broadcast(st), customer.c_nationkey.cast("bigint") == st.location_id
    ).select(F.col("c_custkey").alias("sensor_id"), "location_id", "country_code")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as typed readings with their sensor's country.

    Neither side is ever broadcast: file sizes say little about rows in memory,
    and the readings, by far the larger side, would go through the driver whole.
    Each sensor has one row, so a task's hash table holds its share of them.
    """
    ev = _read(spark, sf_dir, "events")
    geo = sensor_geography(spark, sf_dir).hint("shuffle_hash")
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    pollutant = lookup(F.col("event_type"), EVENT_TYPE_POLLUTANT)
    return ev.join(geo, ev.user_id == geo.sensor_id).select(
        F.col("event_id"),
        F.col("sensor_id"),
        F.col("country_code"),
        ts.alias("reading_ts"),
        F.date_trunc("hour", ts).alias("period_start"),
        pollutant.alias("pollutant"),
        unit_for(pollutant).alias("unit"),
        F.when(k != 0, F.col("value")).alias("value"),
        k.alias("observed_count"),
    )


def _record() -> Column:
    """One reading as a record of a measurement page."""
    start = F.col("period_start")
    return F.struct(
        F.col("value").alias("value"),
        F.struct(F.col("pollutant").alias("name"), F.col("unit").alias("units")).alias(
            "parameter"
        ),
        F.struct(
            F.lit("raw").alias("label"),
            F.lit("01:00:00").alias("interval"),
            F.struct(iso_utc(start).alias("utc")).alias("datetimeFrom"),
            F.struct(iso_utc(start + F.expr("INTERVAL 1 HOUR")).alias("utc")).alias("datetimeTo"),
        ).alias("period"),
        F.struct(
            F.col("observed_count").alias("observedCount"),
            F.col("observed_count").cast("double").alias("percentCoverage"),
        ).alias("coverage"),
    )


def _page_uri() -> Column:
    return F.concat(
        F.lit(LANDING_ROOT + "/"),
        object_name("country_code", day_segment("reading_ts"), "sensor_id"),
    )


def measurement_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-table rows of measurement pages, one verbatim page per reading."""
    return readings(spark, sf_dir).select(
        F.to_json(F.struct(F.array(_record()).alias("results"))).alias("raw_payload"),
        F.col("reading_ts").alias("ingested_at"),
        _page_uri().alias("source_uri"),
        F.to_date("reading_ts").alias("ingest_date"),
    )


def delivered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page lines as a faulty delivery brings them: ``value, source_uri, defect``.

    By event_id modulo 40: 7 is followed by other text, 11 by a second
    document, 13 by a comma and a second document, 17 is cut short, 19 is
    blank, 23 is not JSON; other lines are whole (defect null).
    """
    body = F.to_json(F.struct(F.array(_record()).alias("results")))
    kind = F.col("event_id") % 40
    defects = {
        7: ("trailing text", F.concat(body, F.lit(" junk"))),
        11: ("second document", F.concat(body, body)),
        13: ("joined documents", F.concat(body, F.lit(","), body)),
        17: ("cut", F.substring(body, 1, 25)),
        19: ("blank", F.lit("  ")),
        23: ("no document", F.lit("service unavailable")),
    }
    value, defect = body, F.lit(None).cast("string")
    for k, (name, broken) in defects.items():
        value, defect = F.when(kind == k, broken).otherwise(value), F.when(kind == k, F.lit(name)).otherwise(defect)
    return readings(spark, sf_dir).select(value.alias("value"), _page_uri().alias("source_uri"), defect.alias("defect"))


#: Entries that are no records, added to the day pages of every fifth sensor and more.
ODD_ENTRIES = ("5", '"text"', "null", "[1]")


def day_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-table rows with one page per sensor and day: its readings in the order of event_id.

    After the readings, sensors with id modulo 5 below 4 list one odd entry
    (ODD_ENTRIES at that place).  Each sensor also has an empty page (id
    modulo 3 is 0) or one without an array (1) on its days.  A page holds the
    readings of one sensor and day, so no group grows with the data.
    """
    by_page = readings(spark, sf_dir).groupBy(
        "sensor_id", "country_code", F.to_date("reading_ts").alias("ingest_date")
    ).agg(
        F.array_sort(F.collect_list(F.struct("event_id", F.to_json(_record()).alias("record")))).alias("records"),
        F.max("reading_ts").alias("reading_ts"),
    )
    kind = (F.col("sensor_id") % 5).cast("int")
    odd = F.when(kind < 4, F.concat(F.lit(","), F.element_at(F.array(*map(F.lit, ODD_ENTRIES)), F.least(kind, F.lit(3)) + 1)))
    body = F.concat(
        F.lit('{"results":['), F.array_join(F.transform("records", lambda r: r["record"]), ","),
        F.coalesce(odd, F.lit("")), F.lit("]}"),
    )
    bare = F.when(F.col("sensor_id") % 3 == 0, F.lit('{"results":[]}')).when(F.col("sensor_id") % 3 == 1, F.lit("{}"))
    return by_page.select(
        F.explode(F.array_compact(F.array(body, bare))).alias("raw_payload"),
        F.col("reading_ts").alias("ingested_at"),
        _page_uri().alias("source_uri"),
        "ingest_date",
    )


def station_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per station: the published activity range (see module docstring).

    The events of a sensor become its own range before they meet the station.
    """
    ts = F.col("ts").cast("timestamp")
    ranges = _read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("sensor_id")).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    geo = sensor_geography(spark, sf_dir).select("sensor_id", "location_id").hint("shuffle_hash")
    seen = ranges.join(geo, "sensor_id").groupBy("location_id").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )
    st = stations(spark, sf_dir).select("location_id", "region_key")
    publishes = F.col("region_key") != NO_ACTIVITY_RANGE_REGION
    return st.join(seen, "location_id", "left").select(
        "location_id",
        F.when(publishes, F.col("first_ts") + F.expr("INTERVAL 1 DAY")).alias("first_ts"),
        F.when(publishes, F.col("last_ts") - F.expr("INTERVAL 1 DAY")).alias("last_ts"),
    )


def inventory_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-table rows of inventory pages (``…/{CC}/{day}/locations.json``)."""
    customer = _read(spark, sf_dir, "customer")
    pollutant = lookup(F.col("c_mktsegment"), SEGMENT_POLLUTANT)
    sensors = customer.select(
        F.col("c_nationkey").cast("bigint").alias("location_id"),
        F.floor(F.col("c_custkey") / SENSORS_PER_INVENTORY_PAGE).alias("slice"),
        F.struct(
            F.col("c_custkey").alias("id"),
            F.struct(pollutant.alias("name"), unit_for(pollutant).alias("units")).alias(
                "parameter"
            ),
        ).alias("sensor"),
    )
    slices = sensors.groupBy("location_id", "slice").agg(
        F.array_sort(F.collect_list("sensor")).alias("sensors")
    )
    st = stations(spark, sf_dir)
    act = station_activity(spark, sf_dir)
    located = slices.join(F.broadcast(st), "location_id").join(
        F.broadcast(act), "location_id"
    )
    location = F.struct(
        F.col("location_id").alias("id"),
        F.col("location_name").alias("name"),
        F.col("locality").alias("locality"),
        F.struct(F.col("country_code").alias("code")).alias("country"),
        F.col("is_monitor").alias("isMonitor"),
        F.struct(F.concat(F.lit("provider-"), F.col("locality")).alias("name")).alias("provider"),
        F.struct(
            (F.col("location_id") * 1.5).alias("latitude"),
            (F.col("region_key") * 10.25).alias("longitude"),
        ).alias("coordinates"),
        F.lit("UTC").alias("timezone"),
        F.when(
            F.col("first_ts").isNotNull(), F.struct(iso_utc("first_ts").alias("utc"))
        ).alias("datetimeFirst"),
        F.when(
            F.col("last_ts").isNotNull(), F.struct(iso_utc("last_ts").alias("utc"))
        ).alias("datetimeLast"),
        F.col("sensors").alias("sensors"),
    )
    stamp = ts_lit(INVENTORY_STAMP)
    uri = F.concat(
        F.lit(LANDING_ROOT + "/"),
        object_name("country_code", day_segment(stamp), F.lit(C.LOCATIONS_LEAF)),
    )
    return located.select(
        F.to_json(F.struct(F.array(location).alias("results"))).alias("raw_payload"),
        stamp.alias("ingested_at"),
        uri.alias("source_uri"),
        F.to_date(stamp).alias("ingest_date"),
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw page table: measurement pages and inventory pages together."""
    return measurement_page_rows(spark, sf_dir).unionByName(inventory_page_rows(spark, sf_dir))


def known_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known-bad sensor list derived from ``customer`` (negative balance)."""
    customer = _read(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    geo = sensor_geography(spark, sf_dir)
    return customer.join(geo, customer.c_custkey == geo.sensor_id).select(
        F.col("sensor_id").cast("bigint").alias("sensor_id"),
        F.col("country_code"),
        F.lit(dt.date(2024, 1, 1)).alias("first_seen_failing"),
        F.lit(dt.date(2024, 1, 31)).alias("last_verified_failing"),
        F.lit("negative balance").alias("note"),
    )


# --- long history from lineitem ---------------------------------------------


def history_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of readings in staged-measurement shape."""
    li = _read(spark, sf_dir, "lineitem")
    pollutant = lookup(F.col("l_returnflag"), RETURNFLAG_POLLUTANT)
    start = F.col("l_shipdate").cast("timestamp")
    return li.select(
        F.col("l_suppkey").alias("sensor_id"),
        pollutant.alias("parameter"),
        unit_for(pollutant).alias("unit"),
        F.col("l_quantity").alias("measurement_value"),
        start.alias("period_start_utc"),
    )


def history_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _read(spark, sf_dir, "supplier")
    return supplier.select(
        F.col("s_suppkey").alias("sensor_id"),
        F.col("s_nationkey").cast("bigint").alias("location_id"),
    )


def history_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations(spark, sf_dir).select(
        "location_id", "country_code", F.col("is_monitor").alias("is_reference_monitor")
    )
