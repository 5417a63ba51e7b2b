"""Rows that joins, explodes and unions have multiplied are rows of their own."""

import corpus_pipeline
import pytest
from cases import DOCS, words
from pyspark.sql import functions as F

from stationlake.llm import bpe, mixing, packing, radix_dedup, recompression, simhash, suffix_dedup
from stationlake.llm.common import ROW_KEY, _is_plain_scan, keyed_documents, store, with_row_key


@pytest.fixture(scope="module")
def scan(spark):
    passage = " ".join(words(2, 40))
    texts = [passage, passage + " " + " ".join(words(3, 30)), " ".join(words(4, 50)), "short", "", None]
    rows = [(i, t, "en", "src0", 1) for i, t in enumerate(texts)]
    return store(spark.createDataFrame(rows, DOCS), "scan")


FORMS = {
    "explode": lambda d: d.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("i"),
    "cross join": lambda d: d.crossJoin(d.sparkSession.range(3).select("id")).drop("id"),
    "join": lambda d: d.join(d.sparkSession.createDataFrame([("src0", i) for i in range(3)], "source STRING, i INT"), "source").select(*d.columns),
    "self join": lambda d: d.join(d.select(F.col("lang").alias("l"), F.col("doc_id").alias("other")), F.col("lang") == F.col("l")).where("other < 3").select(*d.columns),
    "union": lambda d: d.unionAll(d).unionAll(d),
}


@pytest.mark.parametrize("form", FORMS)
def test_multiplied_rows_have_keys_of_their_own(scan, form):
    many = FORMS[form](scan)
    assert many.count() == 18 and not _is_plain_scan(many)
    assert with_row_key(many, "doc_id").select(ROW_KEY).distinct().count() == 18
    assert keyed_documents(many).select(ROW_KEY).distinct().count() == 18


@pytest.mark.parametrize("form", ["explode", "self join"])
def test_operators_give_every_row_its_own(scan, form):
    many, n = FORMS[form](scan), 18
    near = simhash.near_duplicates(many)
    assert (near.count(), near.where("stays").count()) == (n, near.select("component_id").distinct().count())
    exact = radix_dedup.exact_duplicates(many)
    assert (exact.count(), exact.where("kept").count()) == (n, 5)
    assert suffix_dedup.remove_repeated_bytes(many).count() == n
    assert recompression.remove_repeated_words(many).count() == n
    assert bpe.encode(many).count() == n
    assert mixing.mix(many).select(ROW_KEY).distinct().count() <= n
    pieces = packing.pack(many)
    assert pieces.select(ROW_KEY).distinct().count() == n
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
    assert pieces.groupBy("sequence_id", "offset").count().where("count > 1").isEmpty()


def test_stages_give_every_row_its_own(spark, scan):
    many = FORMS["explode"](scan)
    assert corpus_pipeline.drop_exact_copies(spark, many, "").count() == 5
    assert corpus_pipeline.drop_near_copies(spark, many, "").count() == simhash.near_duplicates(many).select("component_id").distinct().count()
    assert corpus_pipeline.mix_sources(spark, many, "").count() >= 1
    assert corpus_pipeline.pack_windows(spark, many, "").select(ROW_KEY).distinct().count() == 18


def test_filters_and_projections_of_a_scan_need_no_copy(scan):
    plain = scan.where("doc_id > 1").withColumn("x", F.length("text")).alias("d")
    assert _is_plain_scan(scan) and _is_plain_scan(plain)
    assert keyed_documents(plain).select(ROW_KEY).distinct().count() == 4
