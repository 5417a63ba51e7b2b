"""URL filter: rules on (host, path prefix) matched through hash prefixes.

Each url is expanded into the expressions that a rule could be written as: a
host suffix at a label boundary followed by a prefix of the path.  Expressions
and rules meet in an equi-join on a short hash prefix; the full digest then
confirms the match, and the longest confirmed rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ascii_lower, store

#: Hex digits of the SHA-256 that the join compares (32 bits).
PREFIX_DIGITS = 8
DEFAULT_VERDICT = "allow"
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/ ? #``; path from there up to ``? #``.

    A null url, or one without ``://``, has an empty host and an empty path.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return ascii_lower(host), path


def rules_frame(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host STRING, path STRING, verdict STRING")


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Every ``host suffix + path prefix`` of the given shapes (labels, path characters)."""
    labels = F.split(host, r"\.", -1)
    made = [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= size),
            F.concat(F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)), F.substring(path, 1, size)),
        )
        for n, size in shapes
    ]
    return F.array_compact(F.array(*made))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", id_col: str = "page_id", default: str = DEFAULT_VERDICT
) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict``.

    A rule fits its host and every subdomain of it, if the path starts with the
    rule's path.  The rule with the most characters wins; at equal length the
    longer host, then block.  Rules that are null in host or path fit nothing.
    A null or malformed url has empty host and path, no rule and the default
    verdict.  Repeated rows are each judged; an empty table gives no rows;
    other columns of ``pages`` are left out.

    Distinct (host, path) pairs are expanded, so a url that fills a third of
    the table is matched once.  Only shapes (labels in the host, characters in
    the path) that some rule has are expanded; their number, the one thing
    brought to the driver, is bounded by the lengths of host and path.
    """
    h, p = host_and_path(F.col(url))
    judged = pages.select(F.col(id_col), h.alias("host"), p.alias("path"))
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    digest = F.sha2(F.concat("rule_host", "rule_path"), 256)
    listed = listed.select("*", F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"), digest.alias("digest"))
    shapes = listed.select(F.size(F.split("rule_host", r"\.", -1)), F.length("rule_path")).distinct().collect()
    shapes = sorted((r[0], r[1]) for r in shapes)
    if not shapes:
        return judged.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    asked = (
        judged.select("host", "path").distinct()
        .select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), shapes)).alias("expression"))
        .select("host", "path", F.sha2("expression", 256).alias("full"))
        .select("host", "path", "full", F.substring("full", 1, PREFIX_DIGITS).alias("prefix"))
    )
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.length("rule_host").alias("host_size"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = (
        asked.join(listed, "prefix")
        .where(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    # Stored, so that both sides of the last join are dealt by a plain exchange
    # and a hot url is split at run time.
    matched = store(best, "url-verdicts")
    return judged.join(matched, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
