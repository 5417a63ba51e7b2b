"""A backfill run over one's own fetch log and pages, as table jobs.

A run takes the chunks without a manifest record, keeps the target sensors that
are not on the skip list, and commits in three steps, each a write of its own:

1. *land* — the pages of the fetches that went well go to the raw table as one
   batch, with the inventory pages under the first open chunk of each country;
   then a marker per chunk says under which stamp and for which fetch log;
2. *reconcile* — per chunk, the failure gate over its fetches and the source's
   total against the records of the landed batch;
3. *record* — failed sensor ids of the chunks that pass, then their manifest
   rows.  A manifest row makes a chunk done; nothing else does.

A run that was stopped at any point is run again.  Chunks whose marker fits the
fetch log and whose batch is whole are not landed twice; the rest are landed
under the new run's later stamp, and the newest batch counts.  If any chunk
does not pass, the run ends with an error after recording those that do.

Facts are joined to the chunks they name; sensors without a fetch are counted
from the targets, never paired with chunks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import chunk_label, country_from_uri, object_name, ts_lit
from stationlake.operators import quality as Q
from stationlake.operators import runs as R
from stationlake.session import scratch_path
from stationlake.sources.pages import append_batch, ensure_raw_table, land_batch, read_raw

CHUNK = ["country_code", "chunk_start", "chunk_end"]
#: Chunks named in the error of a stopped run.
NAMED_CHUNKS = 20
MARKER_DDL = "country_code STRING, chunk_start DATE, chunk_end DATE, log_print DECIMAL(38,0), stamp TIMESTAMP"


class RunStopped(RuntimeError):
    """Chunks above the failure gate, or with counts that differ, were left open."""


@dataclass(frozen=True)
class RunTables:
    """Where runs keep their manifest, the failed ids, the landing markers and the landed pages."""

    manifest: str
    failed: str
    landed: str
    raw: str

    @classmethod
    def under(cls, path: str) -> RunTables:
        return cls(f"{path}/manifest", f"{path}/manifest_failed", f"{path}/landed", f"{path}/raw")


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """Landing markers; none before the first landing."""
    try:
        return spark.read.schema(MARKER_DDL).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MARKER_DDL)


def open_fetches(fetch_log: DataFrame, todo: DataFrame, targets: DataFrame) -> DataFrame:
    """The fetches of target sensors in open chunks; neither the log nor the targets are broadcast."""
    wanted = targets.select("country_code", "sensor_id").distinct().hint("shuffle_hash")
    mine = fetch_log.join(wanted, ["country_code", "sensor_id"], "left_semi")
    return mine.join(todo.select(*CHUNK), CHUNK, "left_semi").select(*CHUNK, "sensor_id", "status", "measurements")


def log_prints(fetched: DataFrame, todo: DataFrame) -> DataFrame:
    """Per open chunk a number that differs when any of its fetches does, and the total that the source reports."""
    row = F.xxhash64("sensor_id", "status", "measurements").cast("decimal(38,0)")
    per_chunk = fetched.groupBy(*CHUNK).agg(
        F.sum(row).cast("decimal(38,0)").alias("log_print"),
        F.sum(F.when(F.col("status") == "ok", F.col("measurements"))).alias("api_total"),
    )
    return todo.select(*CHUNK, "chunk_label").join(per_chunk, CHUNK, "left").na.fill(0, ["api_total"]).withColumn(
        "log_print", F.coalesce("log_print", F.lit(0).cast("decimal(38,0)"))
    )


def landed_at(raw: DataFrame, marked: DataFrame) -> DataFrame:
    """``marked`` chunks with ``landed_records``: the measurement records of the batch under their stamp.

    Only the partitions of the stamps' days are read: one per run that left a
    chunk open.  Of these only the pages of marked batches are parsed.
    """
    days = [r[0] for r in marked.select(F.to_date("stamp")).distinct().collect()]
    keys = ["country_code", "chunk_label", "stamp"]
    place = {"country_code": country_from_uri("source_uri"), "chunk_label": R.partition_segment_of("source_uri"), "stamp": F.col("ingested_at")}
    pages = raw.where(F.col("ingest_date").isin(days) if days else F.lit(False)).withColumns(place)
    pages = pages.join(F.broadcast(marked.select(*keys)), keys, "left_semi")  # a row per chunk
    batches = R.landed_by_batch(pages)
    found = batches.withColumnsRenamed({"segment": "chunk_label", "ingested_at": "stamp", "records": "landed_records"})
    return marked.join(found.select(*keys, "landed_records"), keys, "left").na.fill(0, ["landed_records"])


def pages_to_land(pages: DataFrame, inventory: DataFrame, fetched: DataFrame, to_land: DataFrame, todo: DataFrame, root: str) -> DataFrame:
    """Lines of the pages of fetches that went well, and inventories under a country's first open chunk."""
    ok = fetched.where("status = 'ok'").join(to_land.select(*CHUNK), CHUNK, "left_semi").select(*CHUNK, "sensor_id").distinct()
    measured = pages.join(ok, [*CHUNK, "sensor_id"]).select("body", *CHUNK, F.col("sensor_id").cast("string").alias("leaf"))
    first = todo.groupBy("country_code").agg(F.min(F.struct("chunk_start", "chunk_end")).alias("c"))
    first = first.select("country_code", "c.*").join(to_land.select(*CHUNK), CHUNK, "left_semi")
    listed = inventory.join(first, "country_code").select("body", *CHUNK, F.lit(C.LOCATIONS_LEAF).alias("leaf"))
    name = object_name("country_code", chunk_label("chunk_start", "chunk_end"), "leaf")
    return measured.unionByName(listed).select(
        F.col("body").alias("value"), F.concat(F.lit(root.rstrip("/") + "/"), name).alias("source_uri")
    )


def chunk_outcomes(todo: DataFrame, targets: DataFrame, fetched: DataFrame, landed: DataFrame) -> DataFrame:
    """Fetch counts, failure gate and reconciliation per open chunk; ``landed`` as of :func:`landed_at`."""
    per_country = targets.groupBy("country_code").agg(F.count_distinct("sensor_id").alias("sensors_fetched"))
    counted = R.fetch_summary(fetched, CHUNK).drop("sensors_fetched", "sensors_empty")
    summary = todo.join(per_country, "country_code").join(counted, CHUNK, "left").na.fill(
        0, ["sensors_ok", "sensors_failed", "measurements"]
    )
    summary = summary.withColumn(
        "sensors_empty", F.col("sensors_fetched") - F.col("sensors_ok") - F.col("sensors_failed")
    ).withColumn("segment", F.col("chunk_label"))
    gated = R.failure_gate(summary)
    batches = landed.select("country_code", F.col("chunk_label").alias("segment"), "landed_records")
    checked = R.reconcile_counts(gated, batches).select("country_code", "segment", "landed_total", "matches")
    return gated.join(checked, ["country_code", "segment"])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run(
    spark: SparkSession,
    chunks: DataFrame,
    targets: DataFrame,
    fetch_log: DataFrame,
    pages: DataFrame,
    inventory: DataFrame,
    tables: RunTables,
    *,
    skip: DataFrame | None = None,
    stamp: dt.datetime | str | None = None,
    completed_at: dt.datetime | str | None = None,
    root: str = "lake://landing",
    validate: bool = True,
) -> DataFrame:
    """Process the open ones of ``chunks``; return the manifest as it then stands.

    ``chunks``: country_code, chunk_start, chunk_end, chunk_label (as of
    ``plan_chunks``); ``targets``: country_code, sensor_id; ``fetch_log``: the
    chunk's keys, sensor_id, status (ok, empty or failed), measurements;
    ``pages``: the chunk's keys, sensor_id, body; ``inventory``: country_code,
    body; ``skip``: sensor_id.  Fetches and pages of closed chunks and of other
    sensors are left alone.  ``stamp`` is the batch's, later than any earlier
    run's over the same chunks; it and ``completed_at`` are now by default.

    Raises when a country with open chunks has no target sensor, and
    :class:`RunStopped` when a chunk did not pass (the others are recorded).
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    batch, completed = ts_lit(stamp or now), completed_at or stamp or now
    todo = _stored(R.windows_todo(chunks, R.read_manifest(spark, tables.manifest)), "backfill-todo")
    if skip is not None:
        targets = R.skip_known_bad(targets, skip)
    targets = _stored(targets.select("country_code", "sensor_id"), "backfill-targets")  # looked up by three steps
    guard = Q.nonempty_guard(todo, targets, "country_code", "targets")
    R.enforce(guard, "status = 'pass'", "a country with open chunks has no target sensor").write.format("noop").mode("overwrite").save()
    fetched = _stored(open_fetches(fetch_log, todo, targets), "backfill-fetches")  # one view of the log for all steps
    prints = _stored(log_prints(fetched, todo), "backfill-prints")

    ensure_raw_table(spark, tables.raw)
    markers = read_markers(spark, tables.landed)
    later = markers.join(todo.select(*CHUNK), CHUNK, "left_semi").where(F.col("stamp") >= batch)
    if not later.isEmpty():
        raise ValueError("the stamp of a run must be later than those of earlier runs over its chunks")
    newest = markers.groupBy(*CHUNK, "log_print").agg(F.max("stamp").alias("stamp"))
    whole = landed_at(read_raw(spark, tables.raw), prints.join(newest, [*CHUNK, "log_print"]))
    ready = _stored(whole.where("landed_records = api_total"), "backfill-ready")  # before the raw table changes
    to_land = prints.join(ready.select(*CHUNK), CHUNK, "left_anti")
    lines = pages_to_land(pages, inventory, fetched, to_land, todo, root)
    append_batch(land_batch(lines, batch, validate=validate).hint("rebalance", "ingest_date"), tables.raw)
    mark = to_land.withColumn("stamp", batch)
    append_markers(mark, tables.landed)

    landed = ready.unionByName(landed_at(read_raw(spark, tables.raw), mark))
    outcomes = _stored(chunk_outcomes(todo, targets, fetched, landed), "backfill-outcomes")
    R.append_manifest_failed(R.manifest_failed_records(outcomes, fetched, completed), tables.failed)
    R.append_manifest(R.manifest_records(outcomes, completed), tables.manifest)
    stopped = outcomes.where(~(F.col("passes") & F.col("matches"))).select("country_code", "chunk_label").limit(NAMED_CHUNKS).collect()
    if stopped:
        raise RunStopped("chunks left open: " + ", ".join(f"{r[0]} {r[1]}" for r in stopped))
    return R.read_manifest(spark, tables.manifest)


def append_markers(marked: DataFrame, path: str, columns: Sequence[str] = (*CHUNK, "log_print", "stamp")) -> None:
    marked.select(*columns).write.mode("append").parquet(path)
