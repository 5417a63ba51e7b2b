"""Language identification: held-out accuracy, and what decides a prediction."""

import zlib

import numpy as np
import pytest

from stationlake.llm import langid as L
from stationlake.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def net(spark):
    return L.train(read_table(spark, SF, "documents"))


def test_held_out_accuracy(spark):
    docs = read_table(spark, SF, "documents")
    rows = L.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_reader_equals_the_convolution_as_trained(net):
    """Tables of byte pairs give what the taps give byte by byte."""
    windows = np.random.default_rng(1).integers(0, 256, (5, L.WINDOW)).astype(np.uint8)
    pooled = [sum(net.taps[w][k][windows[:, k : L.WINDOW - w + 1 + k]] for k in range(w)).max(axis=1) for w in L.WIDTHS]
    want = L._softmax(np.maximum(np.hstack(pooled) + net.bias, 0) @ net.dense + net.shift)
    assert np.allclose(L.Reader(net).probabilities(windows), want, atol=1e-4)


def test_the_whole_text_counts(net):
    reader = L.Reader(net)
    de, fr = "der die und nicht ein schon ".encode() * 40, "le la et pas une déjà qui ".encode() * 400
    both = reader.read([de, fr, de + fr])
    assert both[2][0] == both[1][0] != both[0][0]


def test_odd_rows(spark, docs, wide_docs, doc_rows, no_docs):
    for frame in (docs, wide_docs):
        rows = L.predict_languages(frame).collect()
        assert len(rows) == len(doc_rows)
        for r, d in zip(rows, doc_rows):
            letters = any(c.isalpha() for c in d[1] or "")
            assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
            assert r["lang_pred"] in ("und", "en", "fr")
            assert r["held_out"] == (d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 1)
    assert L.predict_languages(no_docs).count() == 0
    alone = spark.createDataFrame([(0, "some words", "xx"), (1, "12 34", "xx"), (2, "more", None)], "doc_id BIGINT, text STRING, lang STRING")
    assert {r["lang_pred"] for r in L.predict_languages(alone).collect()} <= {"xx", "und"}
    unlabelled = alone.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in L.predict_languages(unlabelled).collect()} == {"und"}


def test_lang_source_and_id_are_no_inputs(spark, net):
    rows = [(i, "the same text for all", lang) for i, lang in enumerate(("en", "fr", None))]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    assert len({tuple(r["language"]) for r in L.identify(frame, net).collect()}) == 1
