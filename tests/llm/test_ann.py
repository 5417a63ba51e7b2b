"""Nearest neighbours against exact search: recall, exact scores, ties and odd vectors."""

import numpy as np
import pytest

from stationlake.llm import ann as A
from stationlake.llm.common import read_table

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def exact(rows, queries, k):
    """query id -> [(distance, id)] over usable vectors."""
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids])
    out = {}
    for q in queries:
        if q in good:
            d = np.sqrt(((x - good[q]) ** 2).sum(axis=1))
            out[q] = sorted((s, i) for s, i in zip(d.tolist(), ids.tolist()) if i != q)[:k]
    return out


def found(vectors, queries, k=10):
    out = {}
    for r in sorted(A.nearest(vectors, queries, k).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf):
    vectors = read_table(spark, sf, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = exact(rows, [i for i, _ in rows if i % 20 == 0], 10)
    got = found(vectors, vectors.where("vec_id % 20 = 0"))
    scores = {q: dict((i, s) for s, i in exact(rows, [q], len(rows))[q]) for q in want}
    assert set(got) == set(want)
    assert all(s == scores[q][i] for q, hits in got.items() for s, i in hits) and all(h == sorted(h) for h in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


@pytest.mark.parametrize("cell,unit,queries", [(4096, 16384, 4096), (3, 20, 2)])
def test_copies_ties_and_odd_vectors(spark, monkeypatch, cell, unit, queries):
    monkeypatch.setattr(A, "CELL_ROWS", cell)
    monkeypatch.setattr(A, "UNIT_ROWS", unit)
    monkeypatch.setattr(A, "UNIT_QUERIES", queries)
    rng = np.random.default_rng(3)
    point = lambda: rng.normal(size=6).astype(np.float32).astype(float).tolist()
    hot = point()
    rows = [(i, hot) for i in range(40)] + [(100 + i, point()) for i in range(30)]
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [float("nan")] * 6), (504, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (505, [float("inf")] * 6), (None, hot), (0, hot)]
    frame = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    want = exact(rows, [i for i, _ in rows if i is not None and i % 10 == 0], 10)
    got = found(frame, frame.where("vec_id % 10 = 0"))
    assert set(got) == set(want)
    for q in want:
        if q < 40:  # the copies, nearest at distance 0, ties to the smaller id
            assert got[q] == want[q]
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], None), (100, [1.5, 2.0], None)], SCHEMA)
    assert found(few, few) == {0: [(0.5, 100)], 100: [(0.5, 0)]}
    assert A.nearest(few.limit(0), few.limit(0)).count() == 0
    assert A.nearest(few, few.limit(0)).count() == 0


def far_apart(rng):
    """Five vectors, none near another."""
    return [(i, v.tolist()) for i, v in enumerate(10 * np.eye(6)[:5])]


def clusters_and_outliers(rng, outliers):
    """Twenty tight clusters, and vectors with no near neighbour at all."""
    centres = np.repeat(rng.normal(size=(20, 12)), 15, axis=0)
    near = centres + 0.001 * rng.normal(size=centres.shape)
    return [(i, v.tolist()) for i, v in enumerate([*near, *(20 * rng.normal(size=(outliers, 12)))])]


@pytest.mark.parametrize("scale", [1, 100])
@pytest.mark.parametrize("made", [far_apart, lambda r: clusters_and_outliers(r, 6), lambda r: clusters_and_outliers(r, 40)])
def test_any_scale_and_isolated_vectors(spark, made, scale):
    rows = [(i, (scale * np.array(v)).astype(np.float32).astype(float).tolist()) for i, v in made(np.random.default_rng(4))]
    frame = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    want = exact(rows, [i for i, _ in rows], 10)
    got = found(frame, frame)
    assert {q: len(hits) for q, hits in got.items()} == {q: len(hits) for q, hits in want.items()}
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
