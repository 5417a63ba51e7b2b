"""Structured Streaming forms of page ingest and latest-wins correction.

* :func:`ingest_pages_stream` — new raw-zone objects are picked up as they
  land, stamped once per micro-batch (one ``ingested_at`` per batch, the
  stream's equivalent of one load) and appended to the raw table.
* :func:`latest_wins_stream` — measurement records aggregated per
  (sensor, period) with ``max_by`` over the newest-first order; the watermark
  on the period start bounds state to the lookback horizon.
* :func:`corrections_stream` — the same with nothing dropped: one query writes
  each micro-batch once, its newest on-time copy per key and its rows behind
  the lookback horizon, flagged late.  State and late rows come from the same
  batch, so however loads fall into batches no record is lost;
  :func:`with_late_records` (or the batch rebuild) takes the late rows in.

Sinks are ``foreachBatch`` appends to files in the shared folder, with the
checkpoint next to them, so a restarted query resumes where it stopped.  A
micro-batch that was written but not yet recorded in the checkpoint when the
driver died is run again and lands its pages a second time with a later
stamp, the same as a rerun of a batch load; latest-wins staging absorbs the
copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from stationlake import constants as C
from stationlake.operators.dedup import latest_per_key
from stationlake.schemas import RAW_PAGES_DDL
from stationlake.sources.pages import PARTITIONED_TEXT_SCHEMA, append_batch, land_batch, zone_lines


def page_lines_stream(spark: SparkSession, zone: str, root: str = "", max_files: int | None = None) -> DataFrame:
    """Lines of raw-zone objects as they arrive, with the rebuilt ``source_uri``."""
    reader = spark.readStream.schema(PARTITIONED_TEXT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return zone_lines(reader.text(zone), root)


def ingest_pages_stream(lines: DataFrame, raw_table: str, checkpoint: str) -> StreamingQuery:
    """Append every micro-batch as one load batch (``current_timestamp()`` is
    constant within a micro-batch)."""

    def land(batch: DataFrame, batch_id: int) -> None:
        append_batch(land_batch(batch, None, validate=True), raw_table)

    return (
        lines.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def raw_table_stream(spark: SparkSession, raw_table: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_PAGES_DDL)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(raw_table)


def latest_wins_stream(
    records: DataFrame,
    keys: Sequence[str] = ("sensor_id", "period_start_utc"),
    order: Sequence[str] = ("ingested_at", "source_uri", "record_pos"),
    event_time: str = "period_start_utc",
    delay: str = f"{C.LOOKBACK_DAYS} days",
) -> DataFrame:
    """Newest copy per key as a stateful streaming aggregate (update mode)."""
    payload = [c for c in records.columns if c not in keys]
    picked = F.max_by(F.struct(*payload), F.struct(*order)).alias("__latest")
    return (
        records.withWatermark(event_time, delay)
        .groupBy(*keys)
        .agg(picked)
        .select(*keys, "__latest.*")
    )


def run_update_stream(updates: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch's updated keys with its batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(out)

    return (
        updates.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


LATE = "is_late"


def corrections_stream(
    records: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str] = ("sensor_id", "period_start_utc"),
    order: Sequence[str] = ("ingested_at", "source_uri", "record_pos"),
    event_time: str = "period_start_utc",
    delay: str = f"{C.LOOKBACK_DAYS} days",
) -> StreamingQuery:
    """Write every micro-batch of ``records`` as on-time corrections and late rows.

    A row is late when its event time lies more than ``delay`` before the
    newest one of the batches before its own, as a watermark would have it;
    rows without event time are on time.  Of the on-time rows of a key the
    newest copy in the batch is written, of the late ones every row, both to
    the batch's own folder of ``out``; the batch's newest event time goes beside
    it, one row.  A batch that is run again replaces what it wrote and decides
    as before.  What has been seen is files, so no state grows in the executors
    and the newest copy of a key is found by order, not by arrival.
    """
    spark = records.sparkSession
    newest = f"{out}_newest"

    def write(batch: DataFrame, batch_id: int) -> None:
        is_late = F.lit(False)
        if batch_id:
            seen = spark.read.schema("newest TIMESTAMP, batch_id BIGINT").parquet(newest).where(F.col("batch_id") < batch_id)
            bound = seen.agg(F.max("newest") - F.expr(f"INTERVAL {delay}")).first()[0]  # one value
            is_late = F.coalesce(F.col(event_time) < F.lit(bound), F.lit(False))
        flagged = batch.withColumn(LATE, is_late).select(*records.columns, LATE)
        on_time = latest_per_key(flagged.where(~F.col(LATE)), list(keys), [F.col(c).desc_nulls_last() for c in order])
        both = on_time.unionByName(flagged.where(LATE))
        both.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        written = spark.read.schema(both.schema).parquet(f"{out}/batch_id={batch_id}")
        written.agg(F.max(event_time).alias("newest")).write.mode("overwrite").parquet(f"{newest}/batch_id={batch_id}")

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_corrections(spark: SparkSession, out: str, schema) -> DataFrame:
    """All rows that :func:`corrections_stream` wrote, with ``is_late``; ``schema`` is the records'."""
    flagged = StructType([*schema.fields, StructField(LATE, BooleanType())])
    return spark.read.schema(flagged).parquet(out)


def corrected_state(corrections: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest on-time copy of each key."""
    on_time = corrections.where(~F.col(LATE)).drop(LATE)
    return latest_per_key(on_time, list(keys), [F.col(c).desc_nulls_last() for c in order])


def late_records(corrections: DataFrame) -> DataFrame:
    """The late rows, every one."""
    return corrections.where(LATE).drop(LATE)


def with_late_records(state: DataFrame, late: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The stream's state with the late rows taken in: the newest copy of each key."""
    both = state.unionByName(late.select(*state.columns))
    return latest_per_key(both, list(keys), [F.col(c).desc_nulls_last() for c in order])


def current_state(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Latest emitted row per key across all micro-batches."""
    updates = spark.read.parquet(out)
    return latest_per_key(updates, list(keys), [F.col("batch_id").desc()]).drop("batch_id")
