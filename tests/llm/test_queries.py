"""Every dealt query is registered, reads whole tables and matches its SQL where it has one."""

import re

import __spark_entry__ as E
import duckdb
import pytest

from stationlake.llm.oracles import ORACLES
from stationlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
OTHER_ROWS = {"op1_url_filter", "op4_mixing", "op8_ann", "op10_packing", "op11_prefix_trie", "op13_vector_codes"}
TABLES = ("documents", "pages", "embeddings", "conversations")


def test_every_query_is_registered():
    names = E.queries()
    assert [sum(bool(re.match(rf"op{n}_", k)) for k in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_its_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, res = QUERIES[key](spark, SF), con.sql(ORACLES[key])
    assert sorted(df.columns) == sorted(res.columns)
    turn = lambda cols, rows: sorted(repr([r[i] for i in sorted(range(len(cols)), key=cols.__getitem__)]) for r in rows)
    assert turn(df.columns, [tuple(r) for r in df.collect()]) == turn(res.columns, res.fetchall())


@pytest.mark.parametrize("key", sorted(set(QUERIES) - OTHER_ROWS))
def test_one_row_per_document(spark, key):
    df = QUERIES[key](spark, SF)
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count() == df.select("doc_id").distinct().count()


def test_columns_of_the_contracts(spark):
    want = {
        "op1_url_filter": "page_id host path rule verdict",
        "op2_simhash": "doc_id fingerprint component_id",
        "op3_langid": "doc_id held_out lang_pred score",
        "op5_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op7_exact_dedup": "doc_id keep_id group_size kept text_sha256",
        "op8_ann": "query_id rank vec_id score",
        "op9_recompression": "doc_id n_words n_removed kept_sha256",
        "op10_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
        "op12_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op13_vector_codes": "vec_id code error label_error codebooks_sha256",
    }
    for key, columns in want.items():
        assert QUERIES[key](spark, SF).columns == columns.split(), key
