"""Vector codes against plain integer k-means, and the parts of the pruning."""

import hashlib
import math
import random

import numpy as np
import pytest

from stationlake.llm import vector_codes as V

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [np.floor(np.array(r[1], np.float32).astype(np.float64) * 4096).astype(np.int64) for r in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, ints[i].astype("<i4").tobytes()))[:entries]
    cut = [v.reshape(parts, -1).tolist() for v in ints]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(near(v[p], books[p])[1], []).append(v[p])
            for i, g in groups.items():
                books[p][i] = [sum(c) // len(g) for c in zip(*g)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by = {}
    for r, e in zip(kept, errors):
        by[r[2]] = by.get(r[2], 0) + e
    return sorted(repr((r[0], "".join(f"{i:02x}" for _, i in f), e, by[r[2]], digest)) for r, f, e in zip(kept, found, errors))


def check(spark, rows, schema=SCHEMA, **options):
    out, books = V.compress(spark.createDataFrame(rows, schema), **options)
    assert sorted(repr(tuple(r)) for r in out.collect()) == brute([r[:3] for r in rows])
    return books


def vectors(seed, n, dims=16, spread=1.0):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(rng.choice((-1, 0, 1)) * spread, 0.1), 3) for _ in range(dims)], rng.choice((0, 1, None))) for i in range(n)]


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_blocks_of_any_size(spark, block):
    check(spark, vectors(1, 180), block=block)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = vectors(2, 60)
    rows += [rows[5]] * 40  # one very common vector
    rows += [(500, None, 1), (501, [None] * 16, 1), (502, [float("nan")] + [0.0] * 15, 1), (503, [float("inf")] + [0.0] * 15, 1)]
    rows += [(None, rows[7][1], None), (3, rows[9][1], 0), (600, [0.0] * 16, 0), (601, [-0.0] * 16, 0)]
    rows = [(*r, "x", "y") for r in rows]
    check(spark, rows, SCHEMA + ", vid STRING, part STRING", block=16)


def test_fewer_vectors_than_entries_and_none(spark):
    books = check(spark, vectors(3, 5, 8))
    assert books.shape == (8, 5, 1)
    out, books = V.compress(spark.createDataFrame([(1, None, 0)], SCHEMA))
    assert out.count() == 0 and books.size == 0
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_lengths_and_sizes_that_do_not_fit(spark):
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)], SCHEMA))
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1.0] * 9, 0)], SCHEMA))
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1e30] * 8, 0)], SCHEMA))


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (1, 5)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = V.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_short_lists_hold_every_nearest_entry_and_prune():
    rng = np.random.default_rng(4)
    entries = rng.integers(-50, 50, (16, 3))
    pruned = 0
    for _ in range(200):
        points = rng.integers(-3, 4, (20, 3)) + rng.integers(-50, 50, 3)
        listed = V.short_lists(points.min(0)[None], points.max(0)[None], entries)[0]
        every = ((points[:, None] - entries) ** 2).sum(2)
        ties = every == every.min(1, keepdims=True)
        assert listed[ties.any(0)].all()
        code, distance = V.nearest_of(points, entries, np.flatnonzero(listed))
        assert (code == every.argmin(1)).all() and (distance == every.min(1)).all()
        pruned += 16 - listed.sum()
    assert pruned > 200 * 8
