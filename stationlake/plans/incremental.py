"""Incremental sensor-day table: recompute only the days a load touches.

A full refresh reads the whole raw table every run.  A load only carries
readings of a bounded set of days, but the copies of these days' readings may
have been landed at any time: later (corrections) and, where a clock runs
ahead, before the day itself.  So an index is kept beside the table: which days
the pages of each ingest day carry, one small row per pair.  An update:

1. adds the pairs of the batches landed since the last build to the index (a
   high-water mark on ``ingested_at``; the ``ingest_date`` partitions before it
   are pruned); their days are the touched days;
2. stages the pages of every ingest day that carries a touched day, and of no
   other (the partitions to read are known when the read is planned), and keeps
   the touched days by a join: latest-wins meets every copy of their readings;
3. overwrites just those ``measurement_date`` partitions (dynamic partition
   overwrite).

Only sensor-days are stored.  Station metadata is joined when station-days are
read (:func:`read_daily`), so moved sensors and changed flags apply to every
day, and the result equals a full rebuild whatever the load changed.  A day
whose readings were all withdrawn keeps sensor-days with count 0, which the
roll-up leaves out, so its old partition is overwritten like any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions.columns import ts_lit
from stationlake.operators import daily as D
from stationlake.operators import staging as S
from stationlake.schemas import SENSOR_DAY_DDL
from stationlake.session import scratch_path


INDEX_DDL = "measurement_date DATE, ingest_date DATE"


def index_path(path: str) -> str:
    """Where the index of the sensor-day table at ``path`` lies."""
    return f"{path}_landed_days"


def landed_days(raw: DataFrame, since: dt.datetime | str | None = None) -> DataFrame:
    """Distinct (measurement day, ingest day) of the measurement pages landed at or after ``since``."""
    if since is not None:
        stamp = ts_lit(since)
        raw = raw.where((F.col("ingest_date") >= F.to_date(stamp)) & (F.col("ingested_at") >= stamp))
    pages = S.measurement_pages(raw)
    recs = S.parse_measurements(S.measurement_records(pages)).where(F.col("period_start_utc").isNotNull())
    return recs.select(
        F.to_date("period_start_utc").alias("measurement_date"), F.to_date("ingested_at").alias("ingest_date")
    ).distinct()


def write_index(raw: DataFrame, path: str) -> None:
    """Index the whole raw table for the sensor-day table at ``path``."""
    landed_days(raw).write.mode("overwrite").parquet(index_path(path))


def drop_index(spark: SparkSession, path: str) -> None:
    """Say that the table at ``path`` was built without an index: the next update makes one."""
    spark.createDataFrame([(None, None)], INDEX_DDL).write.mode("overwrite").parquet(index_path(path))


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The index of the sensor-day table at ``path`` (a pair may have been added twice), None if there is none."""
    try:
        index = spark.read.schema(INDEX_DDL).parquet(index_path(path))
        return None if not index.where("ingest_date IS NULL").isEmpty() else index.distinct()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_by_day(table: DataFrame, path: str, only_present_days: bool = True) -> None:
    """Write ``table`` partitioned by ``measurement_date``, a day's rows by as few tasks as its size asks for.

    With ``only_present_days`` the days in ``table`` replace their partitions
    and every other day is kept (dynamic overwrite); without it the whole
    table is replaced (a full refresh).
    """
    (
        table.hint("rebalance", "measurement_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_present_days else "static")
        .partitionBy("measurement_date")
        .parquet(path)
    )


def build_sensor_days(raw: DataFrame, path: str) -> None:
    """The sensor-day table of the whole raw table, and its index."""
    write_index(raw, path)
    write_by_day(D.sensor_day_agg(S.stage_measurements(raw)), path, only_present_days=False)


def update_sensor_days(spark: SparkSession, raw: DataFrame, since: dt.datetime | str, path: str) -> DataFrame:
    """Recompute the sensor-days of every day touched by pages landed at or after ``since``.

    Without an index yet, or after a build that made none, the whole raw table
    is indexed first.  Returns the touched days, as stored.  The ingest days to read, at most one
    per partition of the raw table, are the only values brought to the driver.
    Stopped anywhere, an update can be run again with the same ``since``.
    """
    new_path = scratch_path(spark, "landed-days")
    landed_days(raw, since).write.parquet(new_path)
    new = spark.read.schema(INDEX_DDL).parquet(new_path)
    if read_index(spark, path) is None:
        write_index(raw, path)
    else:
        new.write.mode("append").parquet(index_path(path))
    touched = new.select("measurement_date").distinct()
    pairs = read_index(spark, path).join(touched, "measurement_date", "left_semi")
    to_read = [r[0] for r in pairs.select("ingest_date").distinct().collect()]
    if to_read:
        pages = raw.where(F.col("ingest_date").isin(to_read))
        fresh = D.sensor_day_agg(S.stage_measurements(pages)).join(touched, "measurement_date", "left_semi")
        write_by_day(fresh, path)
    return touched


def read_sensor_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SENSOR_DAY_DDL).parquet(path)


def read_daily(spark: SparkSession, path: str, sensors: DataFrame, locations: DataFrame) -> DataFrame:
    """Station-days of the stored sensor-days under the given metadata."""
    return D.roll_up(read_sensor_days(spark, path), sensors, locations)
