"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException, PySparkAttributeError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import scratch_path

#: Row key of an operator's input: unique per row, the same on every read.
ROW_KEY = "row_key"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new path of the shared folder and read it back.

    Cuts the lineage: later steps survive a lost executor without running the
    earlier ones again, and the planner knows the table's size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``df`` with ``row_key``, a key unique per row and stable across reads.

    ``doc_id`` can't be the key: it may be null or repeated.  A plain file scan
    has (hash of the file's path, row index in the file), at no cost.  Any
    other frame, such as a union, or one that joins or explodes have multiplied
    the rows of, is stored once with a running id.
    """
    return _keyed(df, [df[c] for c in columns])


def keyed_documents(df: DataFrame) -> DataFrame:
    """``document`` (a struct of every column of ``df``, whatever their names) with ``row_key``."""
    return _keyed(df, [F.struct(*(df[c] for c in df.columns)).alias("document")])


def _is_plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` has each row of one file scan at most once: nothing but filters and projections above it."""
    try:
        node = df._jdf.queryExecution().analyzed()
    except (AttributeError, PySparkAttributeError):  # a remote session does not show its plans
        return False
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def _keyed(df: DataFrame, picked: list) -> DataFrame:
    if _is_plain_scan(df):
        try:
            meta = df.metadataColumn("_metadata")
            key = F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row"))
            return df.select(*picked, key.alias(ROW_KEY))
        except AnalysisException:  # a relation without files, or a projection that hides their columns
            pass
    key = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row"))
    return store(df.select(*picked, key.alias(ROW_KEY)), "keyed")


def with_group_total(df: DataFrame, key: str, row: str, value: str, name: str, salts: int = 64) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows of the same ``key`` (nulls together).

    ``df`` is a stored table and ``row`` tells its rows apart.  The rows of a
    key are dealt out to ``salts`` groups, and only a group's sum meets the
    others, so no key's rows come together in one task.
    """
    # A struct is never null itself, so null keys meet in the joins as well.
    group = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("value"))
    salted = df.withColumns({"__group": group, "__salt": F.pmod(F.xxhash64(row), F.lit(salts))})
    partial = salted.groupBy("__group", "__salt").agg(F.sum(value).alias("__part"))
    totals = partial.groupBy("__group").agg(F.sum("__part").alias(name))
    spread = partial.drop("__part").join(totals, "__group")
    return salted.join(spread, ["__group", "__salt"]).drop("__group", "__salt")


def ascii_lower(col):
    """A-Z to a-z; other letters stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(col, upper, upper.lower())
