"""Raw zone and raw page table: scan, validate, stamp, append, write.

The raw zone holds newline-delimited page bodies, one verbatim API response
per line.  The raw table holds one row per page:
``raw_payload STRING, ingested_at TIMESTAMP, source_uri STRING, ingest_date DATE``,
partitioned by ``ingest_date`` and only ever appended to.  Identity (country,
sensor) lives in ``source_uri``; nothing is parsed at landing time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stationlake import constants as C
from stationlake.functions.columns import object_name, ts_lit
from stationlake.schemas import ANY_PAGE_DDL, RAW_PAGES_DDL

#: Files of the raw zone: ``country=/part=`` folders; a line is the leaf, a tab and the verbatim body.
PARTITIONED_TEXT_SCHEMA = "value STRING, country STRING, part STRING"


def scan_pages(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    recursive: bool = False,
) -> DataFrame:
    """Read page objects as lines: ``value`` (verbatim) + ``source_uri``.

    ``paths`` may mix prefixes and globs (``…/AE/2026-07-12/*``); every line
    becomes one row with no parsing and no quoting rules.  The file path comes
    from the hidden ``_metadata`` column, so the scan stays a plain file scan.
    """
    if isinstance(paths, str):
        paths = [paths]
    reader = spark.read.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    lines = reader.load(list(paths))
    return lines.select(
        F.col("value"), F.col("_metadata.file_path").alias("source_uri")
    )


def zone_lines(lines: DataFrame, root: str = "") -> DataFrame:
    """``value`` (the body) and the rebuilt ``source_uri`` of raw-zone lines."""
    prefix = F.lit(root.rstrip("/") + "/") if root else F.lit("")
    leaf = F.substring_index("value", "\t", 1)
    return lines.select(
        F.substring("value", F.length(leaf) + 2, F.length("value")).alias("value"),
        F.concat(prefix, object_name("country", "part", leaf)).alias("source_uri"),
    )


def scan_partitioned_pages(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """Read pages written by :func:`write_pages` and rebuild ``source_uri``.

    Country and day (or window) are folders, the leaf starts the line, so the
    number of folders follows the calendar and not the sensors; downstream
    code sees one ``source_uri`` form.
    """
    return zone_lines(spark.read.schema(PARTITIONED_TEXT_SCHEMA).text(path), root)


def is_one_document(value: Column | str) -> Column:
    """Whether a line is exactly one JSON document.

    The line is parsed as the only element of an array, so text after the
    document and a second document are both refused.  So are a blank line, a
    document that repeats an object key (which of the two counts is not
    defined) and one with a string beyond the parser's 20 MB.
    """
    c = F.col(value) if isinstance(value, str) else value
    parsed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return F.coalesce(F.size(F.try_variant_get(parsed, "$", "array<variant>")) == 1, F.lit(False))


def invalid_page_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not one JSON document (the load contract requires none)."""
    return lines.where(~is_one_document("value"))


def _stamp(stamp: dt.datetime | str | Column | None) -> Column:
    if stamp is None:
        return F.current_timestamp()
    return ts_lit(stamp)


def land_batch(
    lines: DataFrame,
    stamp: dt.datetime | str | Column | None = None,
    *,
    validate: bool = True,
) -> DataFrame:
    """Turn scanned lines into raw-table rows of one load batch.

    ``stamp`` is the batch id: one value for every row of the batch
    (``current_timestamp()`` is constant within a query).  With ``validate``
    a line that is not one JSON document (:func:`is_one_document`) fails the
    job, as a typed load would; the check rides in the same projection, so it
    costs no extra pass.
    """
    payload = F.col("value")
    if validate:
        payload = F.when(is_one_document(payload), payload).otherwise(
            F.raise_error(F.concat(F.lit("malformed page line in "), F.coalesce("source_uri", F.lit("?")))).cast("string")
        )
    ts = _stamp(stamp)
    return lines.select(
        payload.alias("raw_payload"),
        ts.alias("ingested_at"),
        F.col("source_uri"),
        F.to_date(ts).alias("ingest_date"),
    )


class RawTableMismatch(ValueError):
    """What lies where the raw table should be is not one."""


def _check_raw(found: StructType, what: str) -> None:
    want = StructType.fromDDL(RAW_PAGES_DDL)
    listed = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema]
    if listed(found) != listed(want):
        raise RawTableMismatch(f"{what} has {found.simpleString()}, a raw table {want.simpleString()}")


def ensure_raw_table(spark: SparkSession, path: str) -> DataFrame:
    """Create the raw table at ``path`` if it does not exist; return a reader.

    An empty append makes the folder, so a later reader finds a table even
    before the first load.  Only a missing path counts as missing: any other
    error (permissions, a wrong store) is raised, and files of another schema
    are refused (RawTableMismatch).
    """
    try:
        _check_raw(spark.read.parquet(path).schema, path)
        return read_raw(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    empty = spark.createDataFrame([], RAW_PAGES_DDL)
    empty.write.mode("append").partitionBy("ingest_date").parquet(path)
    return read_raw(spark, path)


def append_batch(batch: DataFrame, path: str) -> None:
    """Append one batch; never truncates.  A rerun adds a second batch."""
    (
        batch.select("raw_payload", "ingested_at", "source_uri", "ingest_date")
        .write.mode("append")
        .partitionBy("ingest_date")
        .parquet(path)
    )


def declare_raw_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Declare the raw table ``name`` in the catalog if it is not there, over the files at ``path``; return it.

    A table of that name, or files there, with another schema or partitioning
    are refused (RawTableMismatch).  Partitions that other sessions landed are
    taken in.
    """
    location = path.replace("'", "\\'")
    if not spark.catalog.tableExists(name):
        ensure_raw_table(spark, path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({RAW_PAGES_DDL}) USING parquet PARTITIONED BY (ingest_date) LOCATION '{location}'"
    )
    check_raw_table(spark, name)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def check_raw_table(spark: SparkSession, name: str) -> None:
    """Refuse a catalog table that is no raw table (RawTableMismatch)."""
    _check_raw(spark.table(name).schema, name)
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if by != ["ingest_date"]:
        raise RawTableMismatch(f"{name} is partitioned by {by}, a raw table by ingest_date")


def load_batch(batch: DataFrame, name: str) -> None:
    """Append one batch to the declared raw table ``name``, whose schema is checked first; never truncates."""
    check_raw_table(batch.sparkSession, name)
    batch.select("raw_payload", "ingested_at", "source_uri", "ingest_date").write.mode("append").insertInto(name)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_PAGES_DDL).parquet(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Append page bodies byte for byte to the raw zone.

    ``pages`` carries ``country``, ``part``, ``leaf`` and ``body``.  Rows are
    rebalanced on (country, part): a folder is written by one task, or by
    several where AQE splits a large one.  Groups with no page produce no file.
    """
    rows = pages.select(
        F.concat_ws("\t", F.col("leaf").cast("string"), F.col("body")).alias("value"),
        F.col("country"),
        F.col("part"),
    ).hint("rebalance", "country", "part")
    rows.write.mode("append").partitionBy("country", "part").text(path)


def page_kind(uri: Column | str = "source_uri") -> Column:
    """``inventory`` for ``…/locations.json`` leaves, ``measurement`` for the
    rest; a null uri is neither."""
    c = F.col(uri) if isinstance(uri, str) else uri
    leaf = "/" + C.LOCATIONS_LEAF + ".json"
    return F.when(c.endswith(leaf), F.lit("inventory")).when(
        ~c.endswith(leaf), F.lit("measurement")
    )


def record_count(payload: Column | str = "raw_payload") -> Column:
    """Number of records in a page's ``results`` array (0 when absent)."""
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.coalesce(_size_or_null(F.from_json(c, ANY_PAGE_DDL).getField("results")), F.lit(0))


def _size_or_null(arr: Column) -> Column:
    # size() of a null array is -1 outside ANSI mode; keep it null instead.
    return F.when(arr.isNotNull(), F.size(arr))


def page_record_total(raw: DataFrame) -> Column:
    """``coalesce(sum(size(results)), 0)`` over pages, for use inside ``agg``."""
    arr = F.from_json(F.col("raw_payload"), ANY_PAGE_DDL).getField("results")
    return F.coalesce(F.sum(_size_or_null(arr)), F.lit(0)).cast("bigint")
