"""Exact dedup by distributed MSD radix partitioning.

Documents are split by successive bytes of their normalised text: each round
regroups the members of every group that is still open by their next digit (a
run of bytes, longer from round to round).  A group closes when it is single or
when its texts have ended; texts of one closed group are equal byte by byte, so
no digest takes part in the decision.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ROW_KEY, store, with_row_key

#: Bytes that the normal form leaves out: [\x20\x09-\x0D].
BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes of the first digit, and how much longer each next one is.
FIRST_DIGIT = 32
GROWTH = 16
KEY = "STRUCT<file: LONG, row: LONG>"


def normal_form(raw: bytes | None) -> bytes:
    return (raw or b"").translate(None, BLANKS)


def _heads(batches):
    """First digit and digest (an output column only) of each text."""
    for b in batches:
        texts = [normal_form(t) for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *(b.column(i) for i in range(1, 4)),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                pa.array([t[:FIRST_DIGIT] for t in texts], pa.binary()),
            ],
            ["doc_id", "points", ROW_KEY, "text_sha256", "digit"],
        )


def _rests(batches):
    """What follows the first digit of each text."""
    for b in batches:
        rest = pa.array([normal_form(t)[FIRST_DIGIT:] for t in b.column(0).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), rest], [ROW_KEY, "grp", "rest"])


def _repeated(members: DataFrame) -> DataFrame:
    """Groups of two or more members with the same next digit; the least member names the new group."""
    groups = members.groupBy("grp", "digit").agg(F.count("*").alias("n"), F.min(ROW_KEY).alias("next"))
    return store(groups.where("n > 1").select("grp", "digit", "next"), "radix-groups")


def equal_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(every row's facts, closed groups ``row_key -> grp`` of two or more equal texts)."""
    spark = docs.sparkSession
    keyed = with_row_key(docs, id_col, text_col).select(
        F.col(text_col).cast("binary").alias("text"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.length(text_col), F.lit(0)).alias("points"),
        ROW_KEY,
    )
    schema = f"doc_id LONG, points INT, row_key {KEY}, text_sha256 STRING, digit BINARY"
    facts = store(keyed.mapInArrow(_heads, schema), "radix-facts")
    whole = F.struct(F.lit(0).cast("long").alias("file"), F.lit(0).cast("long").alias("row"))
    members = facts.select(ROW_KEY, whole.alias("grp"), "digit")
    closed = spark.createDataFrame([], f"row_key {KEY}, grp {KEY}")
    width, rests = FIRST_DIGIT, None
    while True:
        split = members.join(_repeated(members).hint("merge"), ["grp", "digit"])
        # A digit shorter than asked for is the end of the text.
        ended = (F.length("digit") < width).alias("ended")
        rest = [] if rests is None else [F.when(~ended, F.expr(f"substring(rest, {width + 1})")).alias("rest")]
        met = store(split.select(ROW_KEY, F.col("next").alias("grp"), ended, *rest), "radix-split")
        closed = closed.unionAll(met.where("ended").select(ROW_KEY, "grp"))
        if rests is None:
            texts = keyed.select("text", ROW_KEY).join(met.where("NOT ended").hint("merge"), ROW_KEY).select("text", ROW_KEY, "grp")
            rests = store(texts.mapInArrow(_rests, f"row_key {KEY}, grp {KEY}, rest BINARY"), "radix-rest")
        else:
            rests = met.where("NOT ended").select(ROW_KEY, "grp", "rest")
        if rests.isEmpty():
            return facts, closed
        width *= GROWTH
        members = rests.select(ROW_KEY, "grp", F.substring("rest", 1, width).alias("digit"), "rest")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``row_key, doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after deletion of ``[\\x20\\x09-\\x0D]``; null
    counts as empty, and all empty texts are equal.  Of equal texts the row with
    the most code points in its original text stays, then the smallest doc_id
    (null last), then one of the repeated rows.  ``text_sha256`` is an output of
    the normal form, not a means of comparison.  Texts are read whole; an empty
    table gives no rows; other columns of ``docs`` are not used.

    Counts are partial aggregates and the tables of groups are stored before
    the joins, so a group with a third of all rows is split at run time.  Joins
    that carry text are merge joins at every size, so cost follows the input.
    """
    facts, closed = equal_texts(docs, id_col, text_col)
    rank = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW_KEY)
    facts = facts.drop("digit")
    grouped = store(facts.join(closed, ROW_KEY).select("grp", rank.alias("rank")), "radix-closed")
    keepers = grouped.groupBy("grp").agg(F.min("rank").alias("first"), F.count("*").alias("group_size"))
    keepers = store(keepers.select("grp", F.col("first.doc_id").alias("keep_id"), F.col("first.row_key").alias("keeper"), "group_size"), "radix-keepers")
    verdicts = store(grouped.select("grp", F.col("rank.row_key").alias(ROW_KEY)).join(keepers, "grp").drop("grp"), "radix-verdicts")
    alone = F.col("keeper").isNull()
    return facts.join(verdicts, ROW_KEY, "left").select(
        ROW_KEY,
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keeper") == F.col(ROW_KEY), F.lit(True)).alias("kept"),
        "text_sha256",
    )
