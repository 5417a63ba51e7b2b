"""Query registry: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or what Spark derives from them) whole;
results are passed through :func:`for_compare` so doubles and timestamps
compare cleanly with the SQL oracles in :mod:`stationlake.plans.oracles`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import (
    country_from_uri,
    day_segment,
    object_name,
    rate_pct,
    sensor_id_from_uri,
    ts_lit,
)
from stationlake.operators import audit as A
from stationlake.operators import marts as M
from stationlake.operators import quality as Q
from stationlake.operators import runs as R
from stationlake.operators import staging as S
from stationlake.operators.dedup import table_diff as table_diff_op
from stationlake.operators.windows import chunk_start_of, half_open_filter, lookback_bounds, runs_covering
from stationlake.plans import backfill as B
from stationlake.plans import checks as K
from stationlake.plans import feeds as FD
from stationlake.plans import incremental as IN
from stationlake.plans import latest as L
from stationlake.plans.build import build_all as _build_all
from stationlake.plans.build import layer_counts
from stationlake.plans.check_state import UniqueState
from stationlake.plans.feeds import EventFeed, HistoryFeed
from stationlake.plans.output import for_compare
from stationlake.session import apply_model_conf, scratch_path, session_key
from stationlake.sources import pages as P
from stationlake.sources.seeds import read_thresholds, skip_set
from stationlake.streaming import ingest as ST

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_model_conf(spark)
            return for_compare(fn(spark, sf_dir))

        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return register


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("country_compare")
def country_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: raw pages → staging → station-days → country-day mart."""
    feed = EventFeed(spark, sf_dir)
    return M.country_compare(feed.daily, feed.thresholds)


# --- landing and staging (event world) ---------------------------------------


@query("stage_measurements")
def stage_measurements(spark, sf_dir):
    """Measurement pages → typed records → newest copy per (sensor, period)."""
    return EventFeed(spark, sf_dir).measurements


SECOND_LOAD_FROM = "2024-01-21"


@query("stage_second_load")
def stage_second_load(spark, sf_dir):
    """A bucketed base of staged readings and a later load merged into it without
    shuffling the base; equals staging both at once."""
    pages, root = EventFeed(spark, sf_dir).measurement_raw, scratch_path(spark, "latest")
    later = F.col("ingest_date") >= F.lit(SECOND_LOAD_FROM).cast("date")
    L.build_base(pages.where(~later), root)
    L.merge_load(spark, pages.where(later), root)
    return L.read_staged(spark, root)


@query("stage_locations")
def stage_locations(spark, sf_dir):
    return EventFeed(spark, sf_dir).locations


@query("stage_sensors")
def stage_sensors(spark, sf_dir):
    return EventFeed(spark, sf_dir).sensors


@query("target_sensors")
def target_sensors(spark, sf_dir):
    return S.target_sensors(EventFeed(spark, sf_dir).raw)


@query("explode_page_records")
def explode_page_records(spark, sf_dir):
    """Every record of a sensor's day pages (many records, odd entries, empty
    and missing arrays), before deduplication."""
    recs = S.parse_measurements(S.measurement_records(FD.T.day_pages(spark, sf_dir)))
    return recs.select(
        "sensor_id", "country_code", "record_pos", "parameter", "unit",
        "measurement_value", "period_start_utc", "ingested_at",
    )


@query("path_identity")
def path_identity(spark, sf_dir):
    """Identity parsed from every distinct object path (null where absent)."""
    raw = EventFeed(spark, sf_dir).raw
    return raw.select("source_uri").distinct().select(
        "source_uri",
        sensor_id_from_uri("source_uri").alias("sensor_id"),
        country_from_uri("source_uri").alias("country_code"),
    )


@query("route_pages")
def route_pages(spark, sf_dir):
    raw = EventFeed(spark, sf_dir).raw
    return raw.groupBy(P.page_kind("source_uri").alias("page_kind")).agg(
        F.count(F.lit(1)).alias("pages")
    )


@query("page_record_count")
def page_record_count(spark, sf_dir):
    """Pages and records per country and page kind (records = sum of array sizes)."""
    raw = EventFeed(spark, sf_dir).raw
    return raw.groupBy(
        country_from_uri("source_uri").alias("country_code"),
        P.page_kind("source_uri").alias("page_kind"),
    ).agg(F.count(F.lit(1)).alias("pages"), P.page_record_total(raw).alias("records"))


@query("invalid_page_lines")
def invalid_page_lines(spark, sf_dir):
    """Refused lines per country of a delivery with cut, trailed and doubled documents."""
    bad = P.invalid_page_lines(FD.T.delivered_lines(spark, sf_dir))
    return bad.groupBy(country_from_uri("source_uri").alias("country_code"), "defect").agg(
        F.count(F.lit(1)).alias("invalid_lines")
    )


@query("dedup_latest_measurements")
def dedup_latest_measurements(spark, sf_dir):
    """Per country: landed records, staged rows, and copies dropped by latest-wins."""
    feed = EventFeed(spark, sf_dir)
    landed = S.measurement_records(feed.raw).groupBy("country_code").agg(
        F.count(F.lit(1)).alias("landed_records")
    )
    staged = feed.measurements.groupBy("country_code").agg(F.count(F.lit(1)).alias("staged_rows"))
    out = landed.join(staged, "country_code")
    return out.withColumn("copies_dropped", F.col("landed_records") - F.col("staged_rows"))


@query("late_correction_wins")
def late_correction_wins(spark, sf_dir):
    """Keys landed more than once: how many copies, and the value that won."""
    feed = EventFeed(spark, sf_dir)
    recs = S.parse_measurements(S.measurement_records(feed.raw))
    multi = recs.groupBy("sensor_id", "period_start_utc").agg(
        F.count(F.lit(1)).alias("copies"), F.min("ingested_at").alias("first_ingested_at")
    ).where(F.col("copies") > 1)
    kept = feed.measurements.select(
        "sensor_id", "period_start_utc", "measurement_value", "ingested_at"
    )
    return multi.join(kept, ["sensor_id", "period_start_utc"]).select(
        "sensor_id", "period_start_utc", "copies", "first_ingested_at",
        F.col("ingested_at").alias("kept_ingested_at"),
        F.col("measurement_value").alias("kept_value"),
    )


@query("object_name")
def object_name_q(spark, sf_dir):
    """Object names of the measurement pages with their page counts."""
    r = FD.T.readings(spark, sf_dir)
    name = object_name("country_code", day_segment("reading_ts"), "sensor_id")
    return r.groupBy(name.alias("object_name")).agg(F.count(F.lit(1)).alias("pages"))


@query("threshold_seed")
def threshold_seed(spark, sf_dir):
    """The typed threshold seed matched to every observed (parameter, unit)."""
    feed = EventFeed(spark, sf_dir)
    observed = feed.measurements.select("parameter", "unit").distinct()
    t = feed.thresholds
    joined = observed.join(
        t,
        (observed.parameter == t.pollutant) & (observed.unit == t.unit),
        "left",
    )
    return joined.select(
        observed.parameter, observed.unit, t.averaging_period, t.threshold_value
    )


@query("threshold_csv")
def threshold_csv(spark, sf_dir):
    """Guidelines read from a typed CSV seed (UTF-8 units), matched to the station-days' parameters and units."""
    feed = EventFeed(spark, sf_dir)
    path = scratch_path(spark, "thresholds-csv")
    feed.thresholds.write.option("header", True).option("encoding", "UTF-8").csv(path)
    seed = read_thresholds(spark, path)
    days = feed.daily.groupBy("parameter", "unit").agg(F.count(F.lit(1)).alias("station_days"))
    matched = days.join(seed, (days["parameter"] == seed["pollutant"]) & (days["unit"] == seed["unit"]), "left")
    return matched.select(days["parameter"], days["unit"], "station_days", "averaging_period", "threshold_value")


@query("object_name_any_case")
def object_name_any_case(spark, sf_dir):
    """Object names from country codes in either case: one name per object."""
    r = FD.T.readings(spark, sf_dir)
    code = F.when(F.col("sensor_id") % 2 == 1, F.lower("country_code")).otherwise(F.col("country_code"))
    name = object_name(code, day_segment("reading_ts"), "sensor_id")
    return r.groupBy(name.alias("object_name")).agg(F.count(F.lit(1)).alias("pages"))


# --- raw zone and raw table (written to the shared folder) --------------------

_ZONES: dict[tuple[str, str], str] = {}


def written_zone(spark, sf_dir) -> str:
    """Write the event world's pages into a raw zone once per session and dir."""
    key = (session_key(spark), sf_dir)
    if key not in _ZONES:
        raw = EventFeed(spark, sf_dir).raw
        pages = raw.select(
            country_from_uri("source_uri").alias("country"),
            R.partition_segment_of("source_uri").alias("part"),
            F.regexp_extract("source_uri", r"/([^/]+)\.json$", 1).alias("leaf"),
            F.col("raw_payload").alias("body"),
        )
        path = scratch_path(spark, "raw-zone")
        P.write_pages(pages, path)
        _ZONES[key] = path
    return _ZONES[key]


def zone_folder(name):
    """Value of a folder level of the raw zone, from the object's path."""
    return F.regexp_extract("source_uri", f"/{name}=([^/]+)/", 1)


def whole_zone_objects(spark, zone) -> DataFrame:
    """Every page of the raw zone by the public object reader: its countries dealt out over the path forms."""
    scans = [
        P.scan_pages(spark, f"{zone}/country=A[A-L]/part=*"),
        P.scan_pages(spark, [f"{zone}/country=A[M-R]/part=*", f"{zone}/country=A[S-Z]/part=*"]),
        P.scan_pages(spark, f"{zone}/country=[B-Z]*", recursive=True),
    ]
    return functools.reduce(DataFrame.unionByName, scans)


@query("scan_pages")
def scan_pages(spark, sf_dir):
    """Pages written to the raw zone, scanned back by the public object reader: lines and records by kind."""
    objects = whole_zone_objects(spark, written_zone(spark, sf_dir))
    lines = P.zone_lines(
        objects.select("value", zone_folder("country").alias("country"), zone_folder("part").alias("part")),
        FD.T.LANDING_ROOT,
    )
    return lines.groupBy(
        country_from_uri("source_uri").alias("country_code"),
        P.page_kind("source_uri").alias("page_kind"),
    ).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(P.record_count("value")).cast("bigint").alias("records"),
    )


@query("scan_objects")
def scan_objects(spark, sf_dir):
    """The public object reader over several folders and globs of the raw zone."""
    zone = written_zone(spark, sf_dir)
    lines = P.scan_pages(spark, [f"{zone}/country=AF/part=*", f"{zone}/country=EU/part=2024-01-0*"])
    lines = lines.unionByName(P.scan_pages(spark, f"{zone}/country=AM", recursive=True))
    return lines.groupBy(zone_folder("country").alias("country_code"), zone_folder("part").alias("part")).agg(
        F.count(F.lit(1)).alias("pages")
    )


@query("write_pages_roundtrip")
def write_pages_roundtrip(spark, sf_dir):
    """Parse ∘ write is the identity: values read back from the raw zone."""
    lines = P.scan_partitioned_pages(spark, written_zone(spark, sf_dir), FD.T.LANDING_ROOT)
    raw = P.land_batch(lines, FD.T.INVENTORY_STAMP)
    recs = S.parse_measurements(S.measurement_records(raw))
    return recs.groupBy(
        "country_code", F.to_date("period_start_utc").alias("measurement_date")
    ).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("measurement_value").isNull()).alias("valueless"),
        F.sum("measurement_value").alias("value_sum"),
        F.count_distinct("sensor_id").alias("sensors"),
    )


LOAD_STAMPS = ("2024-02-01 02:05:00", "2024-02-02 02:05:00")


@query("land_batch")
def land_batch_q(spark, sf_dir):
    """Declare the raw table in the catalog, load the same pages twice (a rerun), read back."""
    path = scratch_path(spark, "raw-table")
    name = "raw_pages_" + path.rsplit("-", 1)[1]
    P.declare_raw_table(spark, name, path)
    raw = EventFeed(spark, sf_dir).raw
    lines = raw.select(F.col("raw_payload").alias("value"), "source_uri")
    for stamp in LOAD_STAMPS:
        P.load_batch(P.land_batch(lines, stamp), name)
    table = P.declare_raw_table(spark, name, path)  # as a later session does
    return table.groupBy(
        "ingested_at", "ingest_date", P.page_kind("source_uri").alias("page_kind")
    ).agg(F.count(F.lit(1)).alias("pages"), P.page_record_total(table).alias("records"))


@query("latest_batch_records")
def latest_batch_records(spark, sf_dir):
    """Records of the newest batch under each country/day prefix."""
    return R.latest_batch_records(FD.landed_daily_loads(EventFeed(spark, sf_dir)))


# --- run bookkeeping -----------------------------------------------------------


@query("fetch_summary")
def fetch_summary(spark, sf_dir):
    log = FD.event_fetch_log(EventFeed(spark, sf_dir))
    return R.fetch_summary(log, ["country_code", "segment"])


@query("failed_sensors")
def failed_sensors(spark, sf_dir):
    """Failed sensor ids as rows, by country, day and id."""
    return R.failed_sensors(FD.event_fetch_log(EventFeed(spark, sf_dir)), ["country_code", "segment"])


@query("records_in_latest_batch")
def records_in_latest_batch(spark, sf_dir):
    """The load contract's count for one day across countries, by LIKE and by prefix."""
    loads = FD.landed_daily_loads(EventFeed(spark, sf_dir))
    like = R.records_in_latest_batch(loads, "%/raw/airq/%/2024-01-12/%").withColumn("mode", F.lit("like"))
    prefix = f"{FD.T.LANDING_ROOT}/raw/airq/EU/2024-01-08/"
    return like.unionByName(R.records_in_latest_batch(loads, prefix, mode="prefix").withColumn("mode", F.lit("prefix")))


@query("failure_threshold")
def failure_threshold(spark, sf_dir):
    log = FD.event_fetch_log(EventFeed(spark, sf_dir))
    gated = R.failure_gate(R.fetch_summary(log, ["country_code", "segment"]))
    return gated.select(
        "country_code", "segment", "sensors_fetched", "sensors_failed", "failure_rate", "passes"
    )


@query("reconcile_counts")
def reconcile_counts(spark, sf_dir):
    feed = EventFeed(spark, sf_dir)
    summary = R.fetch_summary(FD.event_fetch_log(feed), ["country_code", "segment"])
    landed = R.latest_batch_records(FD.landed_daily_loads(feed))
    return R.reconcile_counts(summary, landed)


@query("skip_known_bad")
def skip_known_bad(spark, sf_dir):
    """Target sensors without those of a skip list read from CSV."""
    feed = EventFeed(spark, sf_dir)
    targets = FD.inventory_sensors(feed).where(F.col("parameter").isin(*C.TARGET_PARAMETERS))
    path = scratch_path(spark, "skip-list")
    feed.known_bad.select("country_code", "sensor_id", "note").write.option("header", True).csv(path)
    return R.skip_known_bad(targets, skip_set(spark, path))


@query("skip_overlap")
def skip_overlap(spark, sf_dir):
    feed = EventFeed(spark, sf_dir)
    targets = FD.inventory_sensors(feed).where(F.col("parameter").isin(*C.TARGET_PARAMETERS))
    return R.skip_overlap(targets, feed.known_bad).groupBy("country_code").agg(
        F.count(F.lit(1)).alias("skipped_sensors")
    )


@query("plan_chunks")
def plan_chunks_q(spark, sf_dir):
    return FD.event_chunks(EventFeed(spark, sf_dir))


@query("half_open_window")
def half_open_window(spark, sf_dir):
    """Readings per backfill chunk: each reading lands in exactly one chunk,
    whose bounds follow from the country's span (one row per country)."""
    feed = EventFeed(spark, sf_dir)
    r = FD.T.readings(spark, sf_dir).join(F.broadcast(feed.audit_spans), "country_code")  # two-letter codes
    start = chunk_start_of(F.to_date("reading_ts"), "span_start", FD.CHUNK_DAYS)
    end = F.least(F.date_add(start, FD.CHUNK_DAYS), F.date_add("span_end", 1))
    inside = r.select("country_code", start.alias("chunk_start"), end.alias("chunk_end"), F.to_date("reading_ts").alias("day"))
    return half_open_filter(inside, "day", F.col("chunk_start"), F.col("chunk_end")).groupBy(
        "country_code", "chunk_start", "chunk_end"
    ).agg(F.count(F.lit(1)).alias("readings"))


@query("lookback_window")
def lookback_window(spark, sf_dir):
    """Per country and run day: the 7-day window it re-fetches and what is in it."""
    r = FD.T.readings(spark, sf_dir).select("country_code", F.to_date("reading_ts").alias("day"))
    per_day = r.groupBy("country_code", "day").agg(F.count(F.lit(1)).alias("n"))
    runs = per_day.select(
        "country_code", "day", "n", F.explode(runs_covering("day")).alias("run_day")
    )
    out = runs.groupBy("country_code", "run_day").agg(
        F.sum("n").cast("bigint").alias("records"),
        F.count(F.lit(1)).alias("days_with_data"),
    )
    return out.select(
        "country_code", "run_day",
        lookback_bounds("run_day")[0].alias("window_start"),
        lookback_bounds("run_day")[1].alias("window_end"),
        "records", "days_with_data",
    )


def stored_chunks(feed: EventFeed) -> DataFrame:
    """The chunk plan as a table, as a run takes it."""
    return stored(FD.event_chunks(feed), "chunks")


@query("checkpoint_resume")
def checkpoint_resume(spark, sf_dir):
    """A first run checkpointed the early chunks (and was run again after a
    crash); a resumed run plans only the chunks without a record."""
    feed = EventFeed(spark, sf_dir)
    chunks = stored_chunks(feed)
    tables = B.RunTables.under(scratch_path(spark, "backfill"))
    first_run = chunks.where(F.col("chunk_end") <= F.lit(FD.FIRST_RUN_CUTOFF).cast("date"))
    B.run(spark, tables=tables, **FD.backfill_inputs(feed, first_run, 2))
    B.run(spark, tables=tables, **FD.backfill_inputs(feed, first_run, 3))
    return R.windows_todo(chunks, R.read_manifest(spark, tables.manifest))


@query("backfill_run")
def backfill_run(spark, sf_dir):
    """A backfill run over every chunk with skipped sensors, a chunk above the
    failure gate and a chunk whose counts differ, and the run resumed for the
    two: the manifest with the failed ids of each chunk counted."""
    feed = EventFeed(spark, sf_dir)
    tables, chunks = B.RunTables.under(scratch_path(spark, "backfill")), stored_chunks(feed)
    try:
        B.run(spark, tables=tables, **FD.backfill_inputs(feed, chunks, 1))
    except B.RunStopped:
        pass  # the chunks that passed are checkpointed; the others are open
    B.run(spark, tables=tables, **FD.backfill_inputs(feed, chunks, 2))
    keys, manifest = R.MANIFEST_KEYS, R.read_manifest(spark, tables.manifest)
    failed = R.read_manifest_failed(spark, tables.failed, manifest).groupBy(*keys).agg(F.count(F.lit(1)).alias("failed_ids"))
    return manifest.join(failed, keys, "left").na.fill(0, ["failed_ids"])


@query("backfill_landed")
def backfill_landed(spark, sf_dir):
    """What a first backfill run landed, per country and segment: the records
    of each chunk, and the inventory under the first open chunk."""
    feed = EventFeed(spark, sf_dir)
    tables = B.RunTables.under(scratch_path(spark, "backfill"))
    B.run(spark, tables=tables, **FD.backfill_inputs(feed, stored_chunks(feed), 2))
    raw = P.read_raw(spark, tables.raw)
    return raw.groupBy(
        country_from_uri("source_uri").alias("country_code"),
        R.partition_segment_of("source_uri").alias("segment"),
        P.page_kind("source_uri").alias("page_kind"),
    ).agg(P.page_record_total(raw).alias("records"))


@query("backfill_todo")
def backfill_todo(spark, sf_dir):
    """Open chunks with the number of target sensors to fetch after the skip list."""
    feed = EventFeed(spark, sf_dir)
    chunks = FD.event_chunks(feed)
    done = chunks.where(F.col("chunk_end") <= F.lit(FD.FIRST_RUN_CUTOFF).cast("date")).select(
        F.col("country_code").alias("country"),
        F.col("chunk_start").alias("window_start"),
        F.col("chunk_end").alias("window_end"),
    )
    todo = R.windows_todo(chunks, done)
    targets = FD.inventory_sensors(feed).where(F.col("parameter").isin(*C.TARGET_PARAMETERS))
    bad = feed.known_bad.select("sensor_id").distinct().withColumn("skip", F.lit(True))
    per_country = targets.join(bad, "sensor_id", "left").groupBy("country_code").agg(
        F.count(F.lit(1)).alias("sensors_targeted"),
        F.count_if(F.coalesce(F.col("skip"), F.lit(False))).alias("sensors_skipped"),
    )
    out = todo.join(per_country, "country_code", "left")
    return out.withColumn("sensors_to_fetch", F.col("sensors_targeted") - F.col("sensors_skipped"))


# --- gap audit -----------------------------------------------------------------


def _expected(feed: EventFeed):
    return A.expected_sensor_days(feed.sensors, feed.locations, feed.audit_spans)


@query("calendar_spine")
def calendar_spine(spark, sf_dir):
    return A.calendar_spine(EventFeed(spark, sf_dir).audit_spans)


@query("expected_sensor_days")
def expected_sensor_days(spark, sf_dir):
    return _expected(EventFeed(spark, sf_dir))


@query("actual_sensor_days")
def actual_sensor_days(spark, sf_dir):
    return A.actual_sensor_days(EventFeed(spark, sf_dir).records)


@query("gap_classify")
def gap_classify(spark, sf_dir):
    feed = EventFeed(spark, sf_dir)
    return A.gap_classify(_expected(feed), A.actual_sensor_days(feed.records), feed.known_bad)


@query("gap_audit_monthly")
def gap_audit_monthly(spark, sf_dir):
    """The monthly audit by day masks, which are stored once and give the spans as well."""
    feed = EventFeed(spark, sf_dir)
    masks = stored(A.sensor_month_masks(feed.records), "sensor-months")
    return A.gap_audit_by_masks(feed.sensors, feed.locations, masks, feed.known_bad, A.mask_spans(masks))


@query("gap_audit_cells")
def gap_audit_cells(spark, sf_dir):
    """The same monthly audit, counted by classifying every expected cell."""
    feed = EventFeed(spark, sf_dir)
    return A.gap_audit(feed.sensors, feed.locations, feed.records, feed.known_bad, feed.audit_spans)


# --- station-days and marts ------------------------------------------------------


@query("daily_station_agg")
def daily_station_agg(spark, sf_dir):
    return EventFeed(spark, sf_dir).daily


@query("hours_covered")
def hours_covered(spark, sf_dir):
    d = EventFeed(spark, sf_dir).daily
    return d.select("location_id", "parameter", "unit", "measurement_date", "hours_covered", "reading_count")


@query("threshold_flag_24h")
def threshold_flag_24h(spark, sf_dir):
    feed = EventFeed(spark, sf_dir)
    return M.threshold_flag_24h(feed.daily, feed.thresholds)


@query("exceedance_rate")
def exceedance_rate(spark, sf_dir):
    """Country-day rate with its numerator and denominator (seven-year history)."""
    feed = HistoryFeed(spark, sf_dir)
    by_day = M.country_day(feed.daily, feed.thresholds)
    return by_day.select(
        "country_code", "parameter", "unit", "measurement_date",
        "locations_exceeding", "locations_comparable",
        rate_pct("locations_exceeding", "locations_comparable").alias("exceedance_rate"),
    )


@query("annual_compare")
def annual_compare(spark, sf_dir):
    feed = HistoryFeed(spark, sf_dir)
    return M.annual_compare(feed.daily, feed.thresholds)


@query("rolling_7d_range")
def rolling_7d_range(spark, sf_dir):
    """Calendar-range 7-day mean over a history with day gaps."""
    feed = HistoryFeed(spark, sf_dir)
    by_day = M.country_day(feed.daily, feed.thresholds)
    rolled = M.rolling_range_avg(
        by_day, "country_daily_avg", ["country_code", "parameter"], "measurement_date"
    )
    return rolled.select(
        "country_code", "parameter", "unit", "measurement_date", "country_daily_avg", "rolling_7d_avg"
    )


@query("history_daily")
def history_daily(spark, sf_dir):
    """Station-days of the seven-year history (bench's heaviest aggregate)."""
    return HistoryFeed(spark, sf_dir).daily


# --- data quality and the layered build -------------------------------------------


_MODELS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def event_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The event world's model tables, built once per application and data folder; checks read them as stored."""
    key = (session_key(spark), sf_dir)
    if key not in _MODELS:
        feed = EventFeed(spark, sf_dir)
        known_bad = stored(feed.known_bad, "known-bad")
        built = _build_all(spark, feed.raw, feed.thresholds, known_bad, scratch_path(spark, "models"), suite=[])
        _MODELS[key] = built.tables
    return _MODELS[key]


def _dq(kind):
    def run(spark, sf_dir):
        return K.evaluate(K.select(kind), K.with_faults(event_tables(spark, sf_dir)))

    return run


for _key, _kind in (
    ("dq_not_null", "not_null"),
    ("dq_unique", "unique"),
    ("dq_unique_combo", "unique_combination"),
    ("dq_accepted_values", "accepted_values"),
    ("dq_accepted_range", "accepted_range"),
    ("dq_relationships", "relationships"),
):
    query(_key)(_dq(_kind))

#: Days of the first run of the incremental checks.
FIRST_CHECKED = "2024-01-16"
#: Table, key and partition of each incremental check, and whether the key decides the partition.
UNIQUE_STATES = (
    ("stg_measurements", ("sensor_id", "period_start_utc"), "measurement_date", True),
    ("int_daily", ("location_id", "parameter", "measurement_date"), "measurement_date", True),
    ("int_daily", ("location_id", "parameter", "reading_count"), "measurement_date", False),
)


@query("dq_unique_incremental")
def dq_unique_incremental(spark, sf_dir):
    """Uniqueness of faulty tables checked in two runs, the second over the new
    days only: failing keys after each run and the rows that it read."""
    tables = K.with_faults(event_tables(spark, sf_dir))
    out = []
    for name, keys, day, decides in UNIQUE_STATES:
        table = tables[name] if day in tables[name].columns else tables[name].withColumn(day, F.to_date("period_start_utc"))
        state = UniqueState(scratch_path(spark, "unique-state"), keys, day, decides)
        state.check(table.where(F.col(day) < F.lit(FIRST_CHECKED).cast("date")))
        state.check(table)
        runs = state.runs(spark).select(
            F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("column_name"), "run", "rows_read", "failures"
        )
        out.append(runs)
    return functools.reduce(DataFrame.unionByName, out)


DQ_RUN_ID = "event-world-check"


def _built(spark, sf_dir):
    feed = EventFeed(spark, sf_dir)
    return _build_all(
        spark, feed.raw, feed.thresholds, feed.known_bad, scratch_path(spark, "build"),
        run_id=DQ_RUN_ID,
    )


@query("build_all")
def build_all(spark, sf_dir):
    """Staging → station-days → marts with checks between layers; rows per table."""
    return layer_counts(_built(spark, sf_dir))


@query("dq_report")
def dq_report(spark, sf_dir):
    """All checks of a build, appended to the result history and read back."""
    result = _built(spark, sf_dir)
    path = scratch_path(spark, "dq-results")
    Q.append_results(result.report, path)
    return Q.gate(Q.read_results(spark, path))


FRESHNESS_CHECK_TIME = "2024-02-01 06:00:00"
#: Countries whose loads stopped early, with their last loaded day.
STALLED = {"AM": "2024-01-29", "AS": "2024-01-27"}


@query("dq_freshness")
def dq_freshness(spark, sf_dir):
    """Age of each country's newest measurement load at a fixed check time;
    two countries' loads stopped early (a warning and an error)."""
    loads = S.measurement_pages(FD.landed_daily_loads(EventFeed(spark, sf_dir)))
    keyed = loads.withColumn("country_code", country_from_uri("source_uri"))
    last = FD.T.lookup(F.col("country_code"), STALLED)
    keyed = keyed.where(last.isNull() | (R.partition_segment_of("source_uri") <= last))
    countries = FD.T.stations(spark, sf_dir).select("country_code")
    return Q.partition_freshness(keyed, "ingested_at", "ingest_date", FRESHNESS_CHECK_TIME, ["country_code"], countries)


@query("dq_nonempty")
def dq_nonempty(spark, sf_dir):
    """Every country must have target sensors in its inventory; that of one
    country was not delivered."""
    feed = EventFeed(spark, sf_dir)
    countries = FD.T.stations(spark, sf_dir).select("country_code")
    targets = FD.inventory_sensors(feed).where(F.col("parameter").isin(*C.TARGET_PARAMETERS))
    targets = targets.where(F.col("country_code") != "AS")
    return Q.nonempty_guard(countries, targets, "country_code", "target_sensors")


# --- streaming -------------------------------------------------------------------------


@query("stream_ingest_pages")
def stream_ingest_pages(spark, sf_dir):
    """Raw-zone objects streamed into the raw table, one stamp per micro-batch."""
    zone = written_zone(spark, sf_dir)
    table, ckpt = scratch_path(spark, "stream-raw"), scratch_path(spark, "stream-ckpt")
    P.ensure_raw_table(spark, table)
    q = ST.ingest_pages_stream(ST.page_lines_stream(spark, zone, FD.T.LANDING_ROOT), table, ckpt)
    q.awaitTermination()
    raw = P.read_raw(spark, table)
    return raw.groupBy(
        country_from_uri("source_uri").alias("country_code"),
        P.page_kind("source_uri").alias("page_kind"),
    ).agg(F.count(F.lit(1)).alias("pages"), P.page_record_total(raw).alias("records"))


@query("stream_latest_wins")
def stream_latest_wins(spark, sf_dir):
    """Latest-wins staging as a stateful stream over the raw table; its final
    state equals the batch staging of the same pages."""
    table = scratch_path(spark, "raw-for-stream")
    P.append_batch(EventFeed(spark, sf_dir).raw, table)
    recs = S.parse_measurements(S.measurement_records(ST.raw_table_stream(spark, table)))
    slim = recs.select(
        "sensor_id", "period_start_utc", "parameter", "unit", "measurement_value",
        "ingested_at", "source_uri", "record_pos",
    )
    out, ckpt = scratch_path(spark, "stream-latest"), scratch_path(spark, "stream-latest-ckpt")
    q = ST.run_update_stream(ST.latest_wins_stream(slim), out, ckpt)
    q.awaitTermination()
    state = ST.current_state(spark, out, ["sensor_id", "period_start_utc"])
    return state.select(
        "sensor_id", "period_start_utc", "parameter", "unit", "measurement_value", "ingested_at"
    )


FIRST_LOAD_END, OLD_DAYS_END, RECENT_FROM = "2024-01-16", "2024-01-11", "2024-01-28"
LATE_SHIFT = "INTERVAL 30 DAYS"


@query("stream_late_records")
def stream_late_records(spark, sf_dir):
    """Three loads streamed one after another; the third corrects old and recent
    days.  Corrections behind the 7-day horizon are kept as late rows; the
    state with the late rows taken in holds every newest copy."""
    table = scratch_path(spark, "raw-late")
    pages = EventFeed(spark, sf_dir).measurement_raw
    day = F.col("ingest_date")
    lit_day = lambda d: F.lit(d).cast("date")
    again = pages.where((day < lit_day(OLD_DAYS_END)) | (day >= lit_day(RECENT_FROM))).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr(LATE_SHIFT)
    ).withColumn("ingest_date", F.to_date("ingested_at"))
    loads = [pages.where(day < lit_day(FIRST_LOAD_END)), pages.where(day >= lit_day(FIRST_LOAD_END)), again]
    out, ckpt = scratch_path(spark, "corrections"), scratch_path(spark, "corrections-ckpt")
    columns = ["sensor_id", "period_start_utc", "measurement_value", "ingested_at", "source_uri", "record_pos"]
    for load in loads:
        P.append_batch(load, table)
        recs = S.parse_measurements(S.measurement_records(ST.raw_table_stream(spark, table))).select(*columns)
        ST.corrections_stream(recs, out, ckpt).awaitTermination()
    keys, order = ["sensor_id", "period_start_utc"], ["ingested_at", "source_uri", "record_pos"]
    written = ST.read_corrections(spark, out, recs.schema)
    state, dropped = ST.corrected_state(written, keys, order), ST.late_records(written)
    merged = ST.with_late_records(state, dropped, keys, order)
    is_late = dropped.select(*keys).distinct().withColumn("late", F.lit(True))
    return merged.join(is_late, keys, "left").select(
        *keys, "measurement_value", "ingested_at", F.coalesce("late", F.lit(False)).alias("was_late")
    )


EARLY_DAYS = 24


@query("stream_corrections_at_once")
def stream_corrections_at_once(spark, sf_dir):
    """Every landed copy streamed in uneven loads, several of them in one trigger:
    state and late rows together hold what batch staging keeps."""
    table = scratch_path(spark, "raw-at-once")
    pages = EventFeed(spark, sf_dir).measurement_raw
    day = F.dayofmonth("ingest_date")
    early = day <= EARLY_DAYS
    out, ckpt = scratch_path(spark, "corrections"), scratch_path(spark, "corrections-ckpt")
    columns = ["sensor_id", "period_start_utc", "measurement_value", "ingested_at", "source_uri", "record_pos"]
    keys, order = ["sensor_id", "period_start_utc"], ["ingested_at", "source_uri", "record_pos"]
    # The last days come first, so that much of what follows is late.
    for loads in ([~early], [early & (day % 3 == 0), early & (day % 3 == 1)], [early & (day % 3 == 2)]):
        for load in loads:
            P.append_batch(pages.where(load), table)
        recs = S.parse_measurements(S.measurement_records(ST.raw_table_stream(spark, table))).select(*columns)
        ST.corrections_stream(recs, out, ckpt).awaitTermination()
    written = ST.read_corrections(spark, out, recs.schema)
    merged = ST.with_late_records(ST.corrected_state(written, keys, order), ST.late_records(written), keys, order)
    return merged.select(*keys, "measurement_value", "ingested_at")


@query("table_diff")
def table_diff(spark, sf_dir):
    """What a faulty delivery changed: the landed pages against the delivered
    lines (multiset difference both ways), per side and country."""
    landed = EventFeed(spark, sf_dir).measurement_raw.select(F.col("raw_payload").alias("value"), "source_uri")
    delivered = FD.T.delivered_lines(spark, sf_dir).select("value", "source_uri")
    diff = table_diff_op(landed, delivered)
    return diff.groupBy("side", country_from_uri("source_uri").alias("country_code")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_distinct("source_uri").alias("objects")
    )


INCREMENTAL_CUT = "2024-01-16 00:00:00"
WITHDRAWN_DAY = "2024-01-20"
SECOND_INVENTORY = "2024-02-02 02:05:00"


def moved_locations(feed: EventFeed) -> DataFrame:
    """Location records as a second inventory load lists them: every station's
    sensors with an odd id move to the next station of its country by id, and
    the monitor flags flip."""
    sensors = feed.sensors.join(feed.locations.select("location_id", "country_code"), "location_id")
    turn = Window.partitionBy("country_code").orderBy("location_id")
    nxt = F.coalesce(F.lead("location_id").over(turn), F.min("location_id").over(Window.partitionBy("country_code")))
    after = feed.locations.select("location_id", nxt.alias("next_id"))
    return sensors.join(after, "location_id").withColumn(
        "location_id", F.when(F.col("sensor_id") % 2 == 1, F.col("next_id")).otherwise(F.col("location_id"))
    ).select("sensor_id", "parameter", "unit", "location_id")


@query("incremental_daily")
def incremental_daily(spark, sf_dir):
    """Sensor-days built once, then updated only for the days touched by later
    loads: new readings, 7-day lookback re-lands, a day whose readings are all
    withdrawn, and a second inventory load that moves sensors and flips monitor
    flags.  Equals a full rebuild."""
    feed = EventFeed(spark, sf_dir)
    raw_path, days_path = scratch_path(spark, "inc-raw"), scratch_path(spark, "inc-days")
    P.ensure_raw_table(spark, raw_path)
    cut = ts_lit(INCREMENTAL_CUT)
    pages = feed.measurement_raw
    P.append_batch(pages.where(F.col("ingested_at") < cut), raw_path)
    IN.build_sensor_days(P.read_raw(spark, raw_path), days_path)
    lookback = F.expr(f"INTERVAL {C.LOOKBACK_DAYS} DAYS")
    relanded = pages.where((F.col("ingested_at") >= cut - lookback) & (F.col("ingested_at") < cut))
    relanded = relanded.withColumn("ingested_at", F.col("ingested_at") + lookback).withColumn(
        "ingest_date", F.to_date("ingested_at")
    )
    P.append_batch(pages.where(F.col("ingested_at") >= cut).unionByName(relanded), raw_path)
    IN.update_sensor_days(spark, P.read_raw(spark, raw_path), INCREMENTAL_CUT, days_path)
    withdrawn = pages.where(F.col("ingest_date") == F.lit(WITHDRAWN_DAY).cast("date")).withColumn(
        "raw_payload", F.regexp_replace("raw_payload", r'"value":[^,{}]*,', '"value":null,')
    )
    stamp = ts_lit(SECOND_INVENTORY)
    withdrawn = withdrawn.withColumn("ingested_at", stamp).withColumn("ingest_date", F.to_date(stamp))
    P.append_batch(withdrawn, raw_path)
    IN.update_sensor_days(spark, P.read_raw(spark, raw_path), SECOND_INVENTORY, days_path)
    locations = feed.locations.withColumn("is_reference_monitor", ~F.col("is_reference_monitor"))
    return IN.read_daily(spark, days_path, moved_locations(feed), locations)


#: How far the clocks of some sensors' sources run ahead: their readings are landed before their periods.
CLOCK_AHEAD = "INTERVAL 36 HOURS"
EARLY_CUTS = ("2024-01-12 00:00:00", "2024-01-20 00:00:00")


@query("incremental_early")
def incremental_early(spark, sf_dir):
    """Sensor-days built and updated by two later loads while a quarter of the
    sensors report periods ahead of their landing: a day's readings lie in loads
    before it and after it.  Equals a full rebuild."""
    feed = EventFeed(spark, sf_dir)
    raw_path, days_path = scratch_path(spark, "early-raw"), scratch_path(spark, "early-days")
    P.ensure_raw_table(spark, raw_path)
    ahead = sensor_id_from_uri("source_uri") % 4 == 0
    stamp = F.when(ahead, F.col("ingested_at") - F.expr(CLOCK_AHEAD)).otherwise(F.col("ingested_at"))
    pages = feed.measurement_raw.withColumn("ingested_at", stamp).withColumn("ingest_date", F.to_date("ingested_at"))
    first, second = (ts_lit(c) for c in EARLY_CUTS)
    at = F.col("ingested_at")
    P.append_batch(pages.where(at < first), raw_path)
    IN.build_sensor_days(P.read_raw(spark, raw_path), days_path)
    for load, since in ((pages.where((at >= first) & (at < second)), EARLY_CUTS[0]), (pages.where(at >= second), EARLY_CUTS[1])):
        P.append_batch(load, raw_path)
        IN.update_sensor_days(spark, P.read_raw(spark, raw_path), since, days_path)
    return IN.read_daily(spark, days_path, feed.sensors, feed.locations)
