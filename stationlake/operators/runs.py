"""Run bookkeeping as tables: fetch outcomes, failure gate, count
reconciliation, checkpoint manifest and resumable backfill plans.

A fetch log has one row per (run, sensor) with ``status`` in
{ok, empty, failed} and the number of records the source returned.  All
summaries are aggregates with map-side combine; failed sensor ids are returned
as rows, never gathered into one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import ts_lit
from stationlake.schemas import MANIFEST_DDL, MANIFEST_FAILED_DDL
from stationlake.sources.pages import page_kind, record_count

# --- fetch outcomes ----------------------------------------------------------


def fetch_summary(fetch_log: DataFrame, keys: Sequence[str] = ("country_code",)) -> DataFrame:
    """Per key: sensors ok / empty / failed, and records of ok fetches only."""
    s = F.col("status")
    return fetch_log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sensors_fetched"),
        F.count_if(s == "ok").alias("sensors_ok"),
        F.count_if(s == "empty").alias("sensors_empty"),
        F.count_if(s == "failed").alias("sensors_failed"),
        F.coalesce(F.sum(F.when(s == "ok", F.col("measurements"))), F.lit(0))
        .cast("bigint")
        .alias("measurements"),
    )


def failed_sensors(fetch_log: DataFrame, keys: Sequence[str] = ("country_code",)) -> DataFrame:
    """Failed sensor ids as rows, sorted by key then id."""
    return (
        fetch_log.where(F.col("status") == "failed")
        .select(*keys, "sensor_id")
        .orderBy(*keys, "sensor_id")
    )


def failure_rate(failed: Column | str, fetched: Column | str) -> Column:
    """failed / fetched, 0.0 when nothing was fetched."""
    f = F.col(failed) if isinstance(failed, str) else failed
    t = F.col(fetched) if isinstance(fetched, str) else fetched
    return F.coalesce(F.try_divide(f, t), F.lit(0.0))


def failure_gate(summary: DataFrame, threshold: float = C.FAILURE_RATE_THRESHOLD) -> DataFrame:
    """Adds ``failure_rate`` and ``passes`` (a rate strictly above fails)."""
    rate = failure_rate("sensors_failed", "sensors_fetched")
    return summary.withColumn("failure_rate", rate).withColumn(
        "passes", F.col("failure_rate") <= F.lit(threshold)
    )


def enforce(df: DataFrame, condition: Column | str, message: str) -> DataFrame:
    """Fail the job on the first row where ``condition`` is not true (false or null).

    The check is a projection, so it runs inside the job that consumes the
    rows instead of as a separate pass.
    """
    cond = F.expr(condition) if isinstance(condition, str) else condition
    guard = F.when(F.coalesce(cond, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    return df.withColumn("__guard", guard).where(F.col("__guard")).drop("__guard")


# --- landed counts and reconciliation ---------------------------------------

_SEGMENT_PATTERN = r"/raw/[^/]+/[A-Z]{2}/(.+)/[^/]+\.json$"


def partition_segment_of(uri: Column | str = "source_uri") -> Column:
    """The partition segment between country and leaf (a day or a window)."""
    c = F.col(uri) if isinstance(uri, str) else uri
    return F.nullif(F.regexp_extract(c, _SEGMENT_PATTERN, 1), F.lit(""))


def landed_by_batch(raw: DataFrame) -> DataFrame:
    """Records per (country, segment, batch); inventory pages count 0 records
    but still define a batch."""
    from stationlake.functions.columns import country_from_uri

    is_measurement = page_kind("source_uri") == "measurement"
    return (
        raw.select(
            country_from_uri("source_uri").alias("country_code"),
            partition_segment_of("source_uri").alias("segment"),
            "ingested_at",
            F.when(is_measurement, record_count("raw_payload")).alias("records"),
        )
        .groupBy("country_code", "segment", "ingested_at")
        .agg(F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records"))
    )


def latest_batch_records(raw: DataFrame) -> DataFrame:
    """Per (country, segment): measurement records in the newest batch.

    The newest batch is the maximum ``ingested_at`` of *any* page under the
    segment, inventory pages included.  Two aggregates, both partially
    combined map-side: no group is ever gathered whole.
    """
    per_batch = landed_by_batch(raw)
    return per_batch.groupBy("country_code", "segment").agg(
        F.max("ingested_at").alias("latest_batch"),
        F.max_by("records", "ingested_at").alias("landed_records"),
        F.count(F.lit(1)).alias("batches"),
    )


def reconcile_counts(summary: DataFrame, landed: DataFrame) -> DataFrame:
    """Source total vs landed total per (country, segment); mismatch = fail.

    ``summary`` carries ``country_code, segment, measurements``; ``landed`` is
    :func:`latest_batch_records`.
    """
    joined = summary.select("country_code", "segment", "measurements").join(
        landed.select("country_code", "segment", "landed_records"),
        ["country_code", "segment"],
        "left",
    )
    landed_total = F.coalesce(F.col("landed_records"), F.lit(0)).cast("bigint")
    return joined.select(
        "country_code",
        "segment",
        F.col("measurements").alias("api_total"),
        landed_total.alias("landed_total"),
        (F.col("measurements") - landed_total).alias("diff"),
        (F.col("measurements") == landed_total).alias("matches"),
    )


# --- skip lists --------------------------------------------------------------


def skip_known_bad(sensors: DataFrame, skip: DataFrame) -> DataFrame:
    """Sensors not on the skip list (anti join on the distinct id set)."""
    return sensors.join(skip.select("sensor_id").distinct(), "sensor_id", "left_anti")


def skip_overlap(sensors: DataFrame, skip: DataFrame) -> DataFrame:
    """Sensors that are on the skip list (semi join)."""
    return sensors.join(skip.select("sensor_id").distinct(), "sensor_id", "left_semi")


# --- checkpoint manifest -----------------------------------------------------

MANIFEST_KEYS = ["country", "window_start", "window_end"]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Completed windows.  A missing manifest means nothing is done yet; a
    manifest that does not match the declared schema fails the read."""
    try:
        return spark.read.schema(MANIFEST_DDL).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_DDL)


def read_manifest_failed(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Failed sensor ids of completed windows, one distinct row each.

    Ids written by a run that stopped before its manifest rows belong to no
    completion and are left out.
    """
    done = manifest.select(*MANIFEST_KEYS, "completed_at").distinct()
    rows = spark.read.schema(MANIFEST_FAILED_DDL).parquet(path).distinct()
    return rows.join(done, [*MANIFEST_KEYS, "completed_at"], "left_semi").drop("completed_at")


def append_manifest_failed(records: DataFrame, path: str) -> None:
    """Append failed ids; they count once their window's manifest row is there."""
    records.select(*(f.split(" ")[0] for f in MANIFEST_FAILED_DDL.split(", "))).write.mode("append").parquet(path)


def append_manifest(records: DataFrame, path: str) -> None:
    """Append completed-window records.  Readers take distinct keys, so an
    append repeated after a crash is harmless."""
    cols = [F.col(f.split(" ")[0]) for f in MANIFEST_DDL.split(", ")]
    records.select(*cols).write.mode("append").parquet(path)


def completed_windows(manifest: DataFrame) -> DataFrame:
    return manifest.select(*MANIFEST_KEYS).distinct()


def windows_todo(chunks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Chunks with no completed record (anti join on country + window)."""
    done = completed_windows(manifest).select(
        F.col("country").alias("country_code"),
        F.col("window_start").alias("chunk_start"),
        F.col("window_end").alias("chunk_end"),
    )
    return chunks.join(done, ["country_code", "chunk_start", "chunk_end"], "left_anti")


def manifest_records(chunk_outcomes: DataFrame, completed_at: Column | str) -> DataFrame:
    """Manifest rows for chunks whose gate and reconciliation both passed.

    ``chunk_outcomes`` carries per (country, chunk): measurements,
    sensors_ok, sensors_empty, sensors_failed, passes, matches.  The failed
    ids themselves go to the child table written by
    :func:`manifest_failed_records`, one row per id, so a manifest row has a
    fixed size however many sensors fail.
    """
    stamp = ts_lit(completed_at)
    ok = chunk_outcomes.where(F.col("passes") & F.col("matches"))
    return ok.select(
        F.col("country_code").alias("country"),
        F.col("chunk_start").alias("window_start"),
        F.col("chunk_end").alias("window_end"),
        F.col("measurements").cast("bigint").alias("measurements"),
        F.col("sensors_ok").cast("bigint").alias("sensors_with_data"),
        F.col("sensors_empty").cast("bigint").alias("sensors_empty"),
        F.col("sensors_failed").cast("bigint").alias("sensors_failed"),
        stamp.alias("completed_at"),
    )


def manifest_failed_records(chunk_outcomes: DataFrame, fetch_log: DataFrame, completed_at: Column | str) -> DataFrame:
    """Failed sensor ids of the chunks that are checkpointed, with the stamp of their manifest rows."""
    ok = chunk_outcomes.where(F.col("passes") & F.col("matches")).select(
        "country_code", "chunk_start", "chunk_end"
    )
    failed = fetch_log.where(F.col("status") == "failed").select(
        "country_code", "chunk_start", "chunk_end", "sensor_id"
    )
    return failed.join(ok, ["country_code", "chunk_start", "chunk_end"], "left_semi").select(
        F.col("country_code").alias("country"),
        F.col("chunk_start").alias("window_start"),
        F.col("chunk_end").alias("window_end"),
        "sensor_id",
        ts_lit(completed_at).alias("completed_at"),
    )


# --- one uri pattern (the load contract's count query) ------------------------


def uri_matches(pattern: str, mode: str = "like") -> Column:
    """``source_uri`` filter: SQL ``LIKE`` pattern, or a plain prefix.

    A ``LIKE`` pattern treats ``_`` as a wildcard (chunk labels contain
    one); ``mode="prefix"`` matches the text literally.
    """
    c = F.col("source_uri")
    return c.like(pattern) if mode == "like" else c.startswith(pattern)


def records_in_latest_batch(raw: DataFrame, pattern: str, mode: str = "like") -> DataFrame:
    """Measurement records of the newest batch among pages matching ``pattern``.

    The newest batch is ``max(ingested_at)`` over every matching page,
    inventory pages included; inventory pages add no records.  Its stamp, one
    value, is found first from the uris and stamps alone, so that payloads are
    read from that batch's partition only.  Returns one row:
    ``latest_batch``, ``records`` (0 when nothing matches).
    """
    matching = raw.where(uri_matches(pattern, mode))
    stamp = matching.agg(F.max("ingested_at")).first()[0]
    newest = F.lit(stamp).cast("timestamp")
    batch = matching.where((F.col("ingest_date") == F.to_date(newest)) & (F.col("ingested_at") == newest))
    is_measurement = page_kind("source_uri") == "measurement"
    return batch.agg(
        newest.alias("latest_batch"),
        F.coalesce(F.sum(F.when(is_measurement, record_count("raw_payload"))), F.lit(0)).cast("bigint").alias("records"),
    )
