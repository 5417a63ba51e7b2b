"""Latest-wins deduplication (append-only raw data, newest copy of a key wins).

Batch form: ``row_number() = 1`` over the key, newest first.  Catalyst turns
the ``= 1`` filter into a ``WindowGroupLimit`` that keeps one row per key in
each map partition *before* the shuffle, so a key with millions of copies
sends at most one row per input partition across the network.

The streaming form (``streaming.ingest.latest_wins_stream``) is ``max_by`` over
a struct, which is partially aggregated map-side as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__latest_rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order`` (give it newest first)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of each side that the other lacks (multiset difference both ways),
    tagged ``left_only`` / ``right_only``; empty when the tables are equal.

    One grouped signed count over both sides: each row is shuffled once, and
    copies of a row are combined before the shuffle.
    """
    cols = left.columns
    signed = left.withColumn("__n", F.lit(1)).unionByName(right.select(*cols).withColumn("__n", F.lit(-1)))
    counts = signed.groupBy(*cols).agg(F.sum("__n").alias("__n")).where(F.col("__n") != 0)
    side = F.when(F.col("__n") > 0, F.lit("left_only")).otherwise(F.lit("right_only"))
    return counts.select(*cols, side.alias("side"), F.explode(F.sequence(F.lit(1), F.abs("__n").cast("int"))).alias("__i")).drop("__i")
