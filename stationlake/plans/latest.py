"""Latest-wins staging kept as a bucketed table, to which later loads are merged.

Staging a whole raw table again for every load shuffles every reading it ever
held.  Here the staged readings are a catalog table bucketed and sorted by
their key (sensor and period), so a sensor with a long history is spread over
all buckets.  A load is staged by itself, dealt out to the same buckets, and
joined to the base bucket by bucket: only the load is shuffled.  Per key the
newest copy of the two wins, with the same tie-breaks as batch staging, and the
result is written as the next version of the base, each bucket by the task that
merged it.  A version is complete before its name is recorded; a merge that
stops before that is run again from the version before.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators import staging as S
from stationlake.operators.dedup import latest_per_key
from stationlake.session import scratch_path

KEYS = ["sensor_id", "period_start_utc"]
ORDER = ["ingested_at", "source_uri", "record_pos"]
BUCKETS = 64
VERSION_DDL = "version BIGINT, table_name STRING, path STRING, buckets INT"


def newest_copies(raw: DataFrame) -> DataFrame:
    """Staged readings of ``raw`` with what decides between copies (``record_pos`` included)."""
    parsed = S.parse_measurements(S.measurement_records(raw))
    return latest_per_key(parsed, KEYS, [F.col(c).desc_nulls_last() for c in ORDER])


def _write_version(rows: DataFrame, root: str, version: int, buckets: int) -> None:
    spark = rows.sparkSession
    name = f"stg_latest_{uuid.uuid4().hex[:12]}"
    path = f"{root}/v{version}-{name[-12:]}"
    rows.write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(name)
    record = [(version, name, path, buckets)]
    spark.createDataFrame(record, VERSION_DDL).coalesce(1).write.mode("append").parquet(f"{root}/versions")


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(VERSION_DDL).parquet(f"{root}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSION_DDL)


def base(spark: SparkSession, root: str) -> DataFrame:
    """The newest version, as a bucketed table; declared again in a session that does not know it."""
    v = read_versions(spark, root).orderBy(F.col("version").desc(), "table_name").first()  # one row
    if v is None:
        raise ValueError(f"no base has been built under {root}")
    if not spark.catalog.tableExists(v["table_name"]):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(v["path"]).schema)
        by = ", ".join(KEYS)
        spark.sql(
            f"CREATE TABLE {v['table_name']} ({ddl}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
            f"INTO {v['buckets']} BUCKETS LOCATION '{v['path']}'"
        )
    return spark.table(v["table_name"])


def build_base(raw: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """Stage the whole of ``raw`` into the first version under ``root``."""
    rows = newest_copies(raw).repartition(buckets, *KEYS)
    _write_version(rows, root, 1, buckets)


def merged(base_rows: DataFrame, load: DataFrame) -> DataFrame:
    """Per key the newer of the base's and the load's copy (both as of :func:`newest_copies`).

    A full outer join on the key, which the base is bucketed by: the base is
    read bucket by bucket and only ``load`` is exchanged.  Rows without a whole
    key (entries that are no records), which no join key can match, are few and
    are staged again on their own.
    """
    payload = [c for c in base_rows.columns if c not in KEYS]
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in KEYS)
    side = lambda df, name: df.where(keyed).select(
        *(F.col(k).alias(f"{name}_{k}") for k in KEYS), F.struct(*payload).alias(name)
    )
    b, n = side(base_rows, "b"), side(load, "n")
    both = b.join(n.hint("merge"), [b[f"b_{k}"] == n[f"n_{k}"] for k in KEYS], "full_outer")
    order = lambda name: F.struct(*(F.col(f"{name}.{c}") for c in ORDER))
    newer = F.col("b").isNull() | (F.col("n").isNotNull() & (order("n") >= order("b")))
    picked = F.when(newer, F.col("n")).otherwise(F.col("b")).alias("picked")
    keys = [F.when(newer, F.col(f"n_{k}")).otherwise(F.col(f"b_{k}")).alias(k) for k in KEYS]
    rows = both.select(*keys, picked).select(*KEYS, "picked.*").select(*base_rows.columns)
    keyless = base_rows.where(f"NOT ({keyed})").unionByName(load.where(f"NOT ({keyed})"))
    return rows.unionByName(latest_per_key(keyless, KEYS, [F.col(c).desc_nulls_last() for c in ORDER]))


def merge_load(spark: SparkSession, load_raw: DataFrame, root: str) -> None:
    """Merge the pages of one load into the base; the next version is the result.

    One merge at a time: two that start from the same version keep one load only.
    """
    old = base(spark, root)
    v = read_versions(spark, root).agg(F.max("version"), F.max_by("buckets", "version")).first()
    path = scratch_path(spark, "load")
    newest = newest_copies(load_raw)
    newest.write.parquet(path)  # parsed once, read by both parts of the merge
    _write_version(merged(old, spark.read.schema(newest.schema).parquet(path)), root, v[0] + 1, v[1])


def read_staged(spark: SparkSession, root: str) -> DataFrame:
    """The staged readings, as :func:`stationlake.operators.staging.stage_measurements` gives them."""
    return base(spark, root).select(*S.MEASUREMENT_COLUMNS)
