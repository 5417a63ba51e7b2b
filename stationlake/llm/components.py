"""Connected components of a link table (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import store


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.shiftright(h, 20))).first()
    return tuple(row)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has a link to another; root is the smallest node.

    Each round hooks neighbours to the smallest node in sight; the edges end as
    one star per component.  Minima are partial aggregates, so a node with many
    links sends one row per task, and they are stored before the join, so that
    a hot node's links are split at run time.  Every round is stored.
    """
    pairs = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).distinct()
    edges = store(pairs, "links")
    seen = _signature(edges)
    while seen[0]:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "links-min")
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = store(large, "links-large")
        least = store(large.groupBy("a").agg(F.min("b").alias("m")), "links-min")
        hooked = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(hooked.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
