"""Quality classifier: the ordinal fit on synthetic grades, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlake.llm import quality as Q
from stationlake.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_slopes_are_those_of_the_likelihood():
    """Thresholds rise and the fitted tail probabilities match the frequencies of the grades."""
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(3000):
        x = rng.integers(0, 2)
        score = 2.0 * x + rng.logistic()
        rows.append((int((score > 0.5) + (score > 2.0)), np.array([5 + x]), np.ones(1)))
    model = Q.fit_ordinal(rows)
    assert model.thresholds[0] < model.thresholds[1]
    for x in (0, 1):
        grades = np.array([g for g, s, _ in rows if s[0] == 5 + x])
        for k in (0, 1):
            p = 1 / (1 + np.exp(model.thresholds[k] - model.weights[5 + x]))
            assert abs(p - (grades > k).mean()) < 0.03


@pytest.fixture(scope="module")
def split(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    grades = Q.grades_from_labels(labels)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    return docs, grades.where(~fold), grades.where(fold)


def test_held_out_documents(split):
    docs, train, test = split
    rows = Q.classify(docs, train).join(test, "doc_id").collect()
    clean = [r["kept"] for r in rows if r["grade"] == 2]
    other = [r["kept"] for r in rows if r["grade"] < 2]
    assert np.mean(clean) > 0.95 and np.mean(other) < 0.55
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail_probability"] <= 1 for r in rows)
    assert np.mean([r["expected_grade"] for r in rows if r["grade"] == 2]) > np.mean([r["expected_grade"] for r in rows if r["grade"] < 2])


def test_odd_rows(spark, docs, wide_docs, doc_rows):
    labels = spark.createDataFrame([(0, 1, 0), (7, 0, 1), (7, 1, 0), (None, 1, 1), (3, None, 0), (4, 1, None)], "doc_id BIGINT, quality INT, toxic INT")
    grades = Q.grades_from_labels(labels)
    assert sorted(map(tuple, grades.collect())) == [(0, 2), (7, 0)]
    first = [tuple(r) for r in Q.classify(docs, grades).collect()]
    assert sorted(map(repr, first)) == sorted(map(repr, (tuple(r) for r in Q.classify(wide_docs, grades).collect())))
    assert len(first) == len(doc_rows)
    by = dict(zip(map(repr, doc_rows), first))
    for r in doc_rows:
        if not (r[1] or "").strip():
            assert by[repr(r)][1:] == (0.0, 0.0, False)
    assert len({x[1:] for r, x in zip(doc_rows, first) if r[1] == doc_rows[0][1]}) == 1  # equal texts


def test_without_ratings_or_documents(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id BIGINT, grade INT")
    assert Q.classify(docs, none).count() == docs.count()
    assert Q.classify(no_docs, none).count() == 0
