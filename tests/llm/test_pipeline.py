"""The pipeline: each stage on its own input against brute force, and the whole run."""

from collections import Counter

import corpus_pipeline as C
import pytest
from test_radix_dedup import plain as exact_plain
from test_simhash import groups
from test_simhash import plain as fingerprint

from stationlake.llm import mixing, quality, simhash
from stationlake.llm.common import read_table, store

SF = "/root/testdata/sf0.001"
#: Columns by which rows of documents are compared.
ROW = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(frame):
    return [tuple(r) for r in frame.select(*ROW).collect()]


@pytest.fixture(scope="module")
def inputs(spark, docs):
    """Each stage's input on the small tables, and on the odd rows."""
    out = {}
    frame = read_table(spark, SF, "documents")
    for name, stage in C.STAGES:
        out[name] = frame
        frame = store(stage(spark, frame, SF), "t")
    out["end"] = frame
    return out


def both(inputs, name, docs):
    return [inputs[name], docs]


def test_stages_keep_the_columns(inputs):
    names = [n for n, _ in C.STAGES]
    assert 4 <= len(names) <= 5 and all(inputs[n].columns == ROW for n in names)
    assert C.ORACLE_SQL is None


def test_quality_keeps_what_the_classifier_gives_the_best_grade(spark, inputs, docs):
    labels = quality.grades_from_labels(read_table(spark, SF, "labels"))
    for frame in both(inputs, "quality classifier", docs):
        model = quality.train(frame, labels)
        want = [r for r in rows_of(frame) if model.score(r[1])[1] >= quality.KEEP_FROM]
        assert sorted(map(repr, rows_of(C.keep_quality(spark, frame, SF)))) == sorted(map(repr, want))


def test_exact_dedup_keeps_one_of_equal_texts(spark, inputs, docs):
    for frame in both(inputs, "exact dedup", docs):
        rows = rows_of(frame)
        _, kinds = exact_plain(rows)
        kept = rows_of(C.drop_exact_copies(spark, frame, SF))
        assert len(kept) == kinds and not Counter(map(repr, kept)) - Counter(map(repr, rows))
        assert exact_plain(kept)[1] == kinds


def test_near_dedup_keeps_one_of_each_group(spark, inputs, docs):
    for frame in both(inputs, "SimHash near-dedup", docs):
        rows = rows_of(frame)
        group = groups({fingerprint(r[1]) for r in rows}, C.MAX_BITS)
        kept = rows_of(C.drop_near_copies(spark, frame, SF))
        assert Counter(group[fingerprint(r[1])] for r in kept) == Counter(set(group.values()))
        least = {}
        for r in rows:
            root = group[fingerprint(r[1])]
            if r[0] is not None:
                least[root] = min(least.get(root, r[0]), r[0])
        assert all(r[0] == least.get(group[fingerprint(r[1])]) for r in kept)


def test_mixing_and_packing_use_every_selected_token(spark, inputs):
    mixed = inputs["packing"]
    used = mixing.mix(inputs["mixing sources to target weights"]).agg({"take_tokens": "sum"}).first()[0]
    assert mixed.selectExpr("sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+'))").first()[0] == used
    pieces = inputs["end"].collect()
    by = {}
    for p in pieces:
        by.setdefault(tuple(p["row_key"]), []).append(p)
    assert len(by) == mixed.count()
    assert all(sum(p["length"] for p in ps) == ps[0]["doc_tokens"] for ps in by.values())


def test_run_applies_the_stages(spark, inputs):
    columns = [c for c in inputs["end"].columns if c not in ("row_key", "sequence_id", "offset")]
    got = C.run(spark, SF)
    assert got.columns == inputs["end"].columns
    total = lambda f: tuple(f.selectExpr("count(DISTINCT row_key)", "sum(length)").first())
    assert total(got) == total(inputs["end"]) and columns


def test_odd_rows_and_empty_tables_pass_every_stage(spark, docs, wide_docs, no_docs):
    for frame in (docs, wide_docs, no_docs):
        for name, stage in C.STAGES:
            out = store(stage(spark, frame, SF), "odd")
            if name != "packing":
                assert out.columns == frame.columns
            if frame is no_docs:
                assert out.count() == 0


def test_the_near_dedup_operator_is_called_with_its_contract():
    assert (C.SHINGLE_WORDS, C.MAX_BITS) == (3, 2) and simhash.near_duplicates.__defaults__[:2] == (3, 2)
