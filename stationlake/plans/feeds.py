"""Model inputs assembled from the driver tables (see sources.driver_tables).

``EventFeed`` runs the full path raw pages → staging; ``HistoryFeed`` is the
seven-year reading history that feeds the station-day table directly.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import country_from_uri, day_segment, sensor_id_from_uri
from stationlake.operators import daily as D
from stationlake.operators import staging as S
from stationlake.operators.runs import partition_segment_of
from stationlake.operators.windows import chunk_start_of, plan_chunks
from stationlake.sources.pages import append_batch, ensure_raw_table, land_batch, read_raw
from stationlake.sources import driver_tables as T
from stationlake.sources.seeds import read_thresholds


_LANDED: dict[tuple[str, str], str] = {}


def landed_raw_path(spark: SparkSession, sf_dir: str) -> str:
    """Land the event world's raw pages once per application and data folder.

    The raw page table is the stored input of the transform (append-only,
    partitioned by ingest day).  It is derived from the driver tables by one
    Spark job, written to the shared folder, and every query of the same
    application reads it from there, as the transform reads its raw table.
    """
    from stationlake.session import scratch_path, session_key

    key = (session_key(spark), sf_dir)
    if key not in _LANDED:
        path = scratch_path(spark, "raw-pages")
        ensure_raw_table(spark, path)
        append_batch(T.raw_pages(spark, sf_dir).hint("rebalance", "ingest_date"), path)
        _LANDED[key] = path
    return _LANDED[key]


@dataclass
class EventFeed:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def raw(self) -> DataFrame:
        """The whole raw page table (both page kinds), as landed."""
        return read_raw(self.spark, landed_raw_path(self.spark, self.sf_dir))

    # Staging routes pages by uri itself; routing here as well lets each
    # staging function's scan skip the other kind's pages early.
    @cached_property
    def measurement_raw(self) -> DataFrame:
        return S.measurement_pages(self.raw)

    @cached_property
    def inventory_raw(self) -> DataFrame:
        return S.inventory_pages(self.raw)

    @cached_property
    def location_records(self) -> DataFrame:
        return S.location_records(self.inventory_raw)

    @cached_property
    def records(self) -> DataFrame:
        """Parsed records, every landed copy: enough wherever only (sensor, period) counts."""
        parsed = S.parse_measurements(S.measurement_records(self.measurement_raw))
        return parsed.where(F.col("period_start_utc").isNotNull())

    @cached_property
    def measurements(self) -> DataFrame:
        return S.stage_measurements(self.measurement_raw)

    @cached_property
    def sensors(self) -> DataFrame:
        return S.stage_sensors(self.inventory_raw, self.location_records)

    @cached_property
    def locations(self) -> DataFrame:
        return S.stage_locations(self.inventory_raw, self.location_records)

    @cached_property
    def daily(self) -> DataFrame:
        return D.daily_station_agg(self.measurements, self.sensors, self.locations)

    @cached_property
    def thresholds(self) -> DataFrame:
        return read_thresholds(self.spark)

    @cached_property
    def known_bad(self) -> DataFrame:
        return T.known_bad(self.spark, self.sf_dir)

    @cached_property
    def audit_spans(self) -> DataFrame:
        """Per country: first to last day with a reading.

        Latest-wins never changes which (sensor, day) pairs exist, so the
        records give the same span as the staged measurements without the
        dedup shuffle.
        """
        day = F.to_date("period_start_utc")
        return self.records.groupBy("country_code").agg(
            F.min(day).alias("span_start"), F.max(day).alias("span_end")
        )


@dataclass
class HistoryFeed:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def measurements(self) -> DataFrame:
        return T.history_readings(self.spark, self.sf_dir)

    @cached_property
    def sensors(self) -> DataFrame:
        return T.history_sensors(self.spark, self.sf_dir)

    @cached_property
    def locations(self) -> DataFrame:
        return T.history_locations(self.spark, self.sf_dir)

    @cached_property
    def daily(self) -> DataFrame:
        return D.daily_station_agg(self.measurements, self.sensors, self.locations)

    @cached_property
    def thresholds(self) -> DataFrame:
        return read_thresholds(self.spark)


# --- run tables of the event world -------------------------------------------

CHUNK_DAYS = 7  # backfill chunk width used for the event world's month of data
FIRST_RUN_CUTOFF = "2024-01-15"  # chunks ending on or before this were done by an earlier run


def daily_load_stamp(day_col):
    """Each day's objects are loaded the next morning at 02:05 UTC: one batch per day."""
    return F.to_timestamp(day_col) + F.expr("INTERVAL 26 HOURS 5 MINUTES")


#: A day's objects are loaded twice where the first load broke off after the even sensors.
REPEATED_LOAD_DAYS = 4  # days of the month divisible by this
#: Sensors whose source reports one record more than it delivers.
OVERCOUNT_MODULO, OVERCOUNT_REST = 50, 7
#: Percent of fetches that fail, by the day of the month modulo 3: below, at and above the gate.
FAILING_PERCENT = (12, 20, 30)
EMPTY_FROM_PERCENT = 92


def fetch_lot(sensor_id, day):
    """0 to 99, even over the sensors of a day."""
    return F.pmod(sensor_id * 37 + F.dayofyear(day) * 11, F.lit(100))


def fetch_status(sensor_id, day):
    """ok, failed or empty of the fetch of one sensor and day."""
    lot, kind = fetch_lot(sensor_id, day), F.dayofmonth(day) % 3
    failing = F.when(kind == 0, FAILING_PERCENT[0]).when(kind == 1, FAILING_PERCENT[1]).otherwise(FAILING_PERCENT[2])
    return F.when(lot < failing, "failed").when(lot >= EMPTY_FROM_PERCENT, "empty").otherwise("ok")


def event_daily_loads(feed: EventFeed) -> DataFrame:
    """The raw pages re-landed the way the daily runs load them: the objects
    under ``…/{CC}/{day}/`` form one batch stamped the morning after.  Only
    pages of fetches that went well are landed; on some days an hour's
    earlier batch with the even sensors was broken off and loaded again."""
    sensor, day = sensor_id_from_uri("source_uri"), F.to_date(partition_segment_of("source_uri"))
    went_well = F.coalesce(fetch_status(sensor, day) == "ok", F.lit(True))  # inventory pages have no sensor
    lines = feed.raw.where(went_well).select(F.col("raw_payload").alias("value"), "source_uri")
    stamp = daily_load_stamp(day)
    broken = lines.where((F.dayofmonth(day) % REPEATED_LOAD_DAYS == 0) & (sensor % 2 == 0))
    first = land_batch(broken, stamp - F.expr("INTERVAL 1 HOUR"), validate=False)
    return land_batch(lines, stamp, validate=False).unionByName(first)


_LOADS: dict[tuple[str, str], str] = {}


def landed_daily_loads(feed: EventFeed) -> DataFrame:
    """The raw table as the daily runs loaded it, landed once per application and data folder."""
    from stationlake.session import scratch_path, session_key

    key = (session_key(feed.spark), feed.sf_dir)
    if key not in _LOADS:
        path = scratch_path(feed.spark, "daily-loads")
        ensure_raw_table(feed.spark, path)
        append_batch(event_daily_loads(feed).hint("rebalance", "ingest_date"), path)
        _LOADS[key] = path
    return read_raw(feed.spark, _LOADS[key])


def inventory_sensors(feed: EventFeed) -> DataFrame:
    """Every inventoried sensor with its station's country."""
    loc = feed.locations.select("location_id", "country_code")
    return feed.sensors.join(loc, "location_id").select("sensor_id", "parameter", "country_code")


def event_fetch_log(feed: EventFeed) -> DataFrame:
    """One fetch outcome per sensor and day that the source has readings of.

    Taken from the ``events`` rows, not from the landed pages, so that counts
    and landed batches are independent.  ``measurements`` is what the source
    says it returned; some sensors report one record too many.
    """
    r = T.readings(feed.spark, feed.sf_dir)
    counts = r.groupBy("country_code", "sensor_id", F.to_date("reading_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    over = F.when(F.col("sensor_id") % OVERCOUNT_MODULO == OVERCOUNT_REST, 1).otherwise(0)
    status = fetch_status(F.col("sensor_id"), F.col("day"))
    return counts.select(
        "country_code",
        day_segment("day").alias("segment"),
        "day",
        "sensor_id",
        status.alias("status"),
        F.when(status == "ok", F.col("n") + over).otherwise(0).cast("bigint").alias("measurements"),
    )


def event_chunks(feed: EventFeed, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Backfill chunks over each country's span ``[first day, last day + 1)``."""
    windows = feed.audit_spans.select(
        "country_code",
        F.col("span_start").alias("window_start"),
        F.date_add("span_end", 1).alias("window_end"),
    )
    return plan_chunks(windows, chunk_days).select(
        "country_code", "chunk_start", "chunk_end", "chunk_label"
    )


# --- a source for backfill runs: what fetching each chunk brought --------------

#: One batch stamp and completion time per attempt.
BACKFILL_STAMPS = {1: "2024-02-01 02:00:00", 2: "2024-02-02 02:00:00", 3: "2024-02-03 02:00:00"}
COMPLETED_AT = {1: "2024-02-01 03:00:00", 2: "2024-02-02 03:00:00", 3: "2024-02-03 03:00:00"}
CHUNK = ["country_code", "chunk_start", "chunk_end"]


def in_chunks(rows: DataFrame, chunks: DataFrame, day: str) -> DataFrame:
    """``rows`` with the bounds of the chunk that ``day`` falls in.

    The chunks of a country abut and are equally long, so a row's chunk follows
    from the country's first one (one row per country).
    """
    spans = chunks.groupBy("country_code").agg(F.min("chunk_start").alias("span_start"), F.max("chunk_end").alias("span_end"))
    keyed = rows.join(F.broadcast(spans), "country_code")  # one row per country
    start = chunk_start_of(day, "span_start", CHUNK_DAYS)
    end = F.least(F.date_add(start, CHUNK_DAYS), F.col("span_end"))
    inside = keyed.where((F.col(day) >= F.col("span_start")) & (F.col(day) < F.col("span_end")))
    return inside.withColumns({"chunk_start": start, "chunk_end": end}).drop("span_start", "span_end")


def unreachable(attempt: int):
    """Sensors that can't be reached at first: a third of America's in its second chunk, with or without readings."""
    chunk = (F.col("country_code") == "AM") & (F.dayofmonth("chunk_start") > 7) & (F.dayofmonth("chunk_start") < 15)
    return chunk & (F.col("sensor_id") % 3 == 0) if attempt == 1 else F.lit(False)


def overcounted(attempt: int):
    """Sensors whose source reports a record too many: one in ten of Europe's third chunk at first."""
    chunk = (F.col("country_code") == "EU") & (F.dayofmonth("chunk_start") > 14) & (F.dayofmonth("chunk_start") < 22)
    return chunk & (F.col("sensor_id") % 10 == 1) if attempt == 1 else F.lit(False)


def backfill_fetch_log(feed: EventFeed, chunks: DataFrame, attempt: int) -> DataFrame:
    """One row per fetch of a sensor and chunk that brought readings or failed.

    Readings come from the source's rows; one fetch in ten fails.  Fetches that
    brought nothing have no row.
    """
    r = T.readings(feed.spark, feed.sf_dir).select("country_code", "sensor_id", F.to_date("reading_ts").alias("day"))
    counts = in_chunks(r, chunks, "day").groupBy(*CHUNK, "sensor_id").agg(F.count(F.lit(1)).alias("n"))
    fails = (F.col("sensor_id") + F.dayofyear("chunk_start")) % 10 == 0
    over = F.when(overcounted(attempt), 1).otherwise(0)
    reached = counts.where(~unreachable(attempt)).select(
        *CHUNK, "sensor_id",
        F.when(fails, F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
        F.when(fails, 0).otherwise(F.col("n") + over).cast("bigint").alias("measurements"),
    )
    if attempt > 1:
        return reached
    # One chunk has an outage: its sensors fail whether they had readings or not.
    outage = chunks.where((F.col("country_code") == "AM") & F.dayofmonth("chunk_start").between(8, 14)).select(*CHUNK)
    sensors = inventory_sensors(feed).select("country_code", "sensor_id")
    lost = sensors.join(outage, "country_code").where(unreachable(attempt)).select(
        *CHUNK, "sensor_id", F.lit("failed").alias("status"), F.lit(0).cast("bigint").alias("measurements")
    )
    return reached.unionByName(lost)


def backfill_pages(feed: EventFeed, chunks: DataFrame) -> DataFrame:
    """Every measurement page under the chunk that its day falls in."""
    pages = feed.measurement_raw.select(
        country_from_uri("source_uri").alias("country_code"),
        sensor_id_from_uri("source_uri").alias("sensor_id"),
        F.to_date("ingested_at").alias("day"),
        F.col("raw_payload").alias("body"),
    )
    return in_chunks(pages, chunks, "day").drop("day")


def backfill_inputs(feed: EventFeed, chunks: DataFrame, attempt: int) -> dict:
    """Everything of the event world that a backfill run takes, by argument name."""
    targets = inventory_sensors(feed).where(F.col("parameter").isin(*C.TARGET_PARAMETERS))
    return {
        "chunks": chunks,
        "targets": targets,
        "fetch_log": backfill_fetch_log(feed, chunks, attempt),
        "pages": backfill_pages(feed, chunks),
        "inventory": feed.inventory_raw.select(country_from_uri("source_uri").alias("country_code"), F.col("raw_payload").alias("body")),
        "skip": feed.known_bad,
        "stamp": BACKFILL_STAMPS[attempt],
        "completed_at": COMPLETED_AT[attempt],
        "root": T.LANDING_ROOT,
        "validate": False,  # pages of the landed raw table
    }
