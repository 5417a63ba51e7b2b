"""The training-data pipeline: quality, exact dedup, near-dedup, mixing, packing.

``STAGES`` lists (name, function).  Each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``documents``.

Rows are told apart by a key of the row, not by ``doc_id``: null and repeated
doc_ids, repeated rows and further columns pass through like any other.  An
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import mixing, packing, quality, radix_dedup, simhash
from stationlake.llm.common import ROW_KEY, keyed_documents, read_table, store

#: Shingle length and most differing bits of the near-dedup stage.
SHINGLE_WORDS = 3
MAX_BITS = 2
SCORE = "pipeline_quality_score"


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose key is in ``gone``."""
    gone = store(gone.select(ROW_KEY), "dropped-rows")
    return keyed_documents(docs).join(gone.hint("merge"), ROW_KEY, "left_anti").select("document.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier, fitted on this stage's rated documents, gives the best grade; blank texts go."""
    ratings = quality.grades_from_labels(read_table(spark, sf_dir, "labels"))
    model = quality.train(docs, ratings)
    rows = quality.scored(docs, model, name=SCORE)
    return rows.where(F.col(f"{SCORE}.tail_probability") >= quality.KEEP_FROM).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest original stays, then the smallest doc_id."""
    return _without(docs, radix_dedup.exact_duplicates(docs).where("NOT kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the smallest doc_id stays."""
    return _without(docs, simhash.near_duplicates(docs, SHINGLE_WORDS, MAX_BITS).where("NOT stays"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents used by the mixture, one row per epoch, the last one of a leaf cut to its budget."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its ids; ``row_key`` tells uses of one document apart."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

#: A fitted classifier and 64-bit fingerprints can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage-" + "-".join(name.lower().split()))
    return STAGES[-1][1](spark, docs, sf_dir)
