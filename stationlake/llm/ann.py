"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of ``COORDINATES`` random projections,
each cut in steps of the same width.  A query looks into its own cell and into
cells one step away in some coordinates, in the order of their estimated
success: the sum of the squared distances to the walls between.  The cells of
all tables give the candidates, whose distances are then computed exactly.
Queries that find fewer than k are ranked against all entries.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import store

TABLES = 2
COORDINATES = 8
SEED = 5
#: The sample that the step width and the number of probes are fitted on, and how many of it ask.
SAMPLE_ROWS = 3000
SAMPLE_QUERIES = 200
#: Steps tried, as multiples of the sample's median distance to the nearest neighbour.
STEPS = (1.5, 2.0, 2.5, 3.0)
TARGET_RECALL = 0.96
#: Rows of a cell, of a unit of work, and queries of a unit, at most (about).
CELL_ROWS = 4096
UNIT_ROWS = 16384
UNIT_QUERIES = 4096


def _moves() -> np.ndarray:
    """Every perturbation: -1, 0 or +1 in each coordinate."""
    return np.array(list(itertools.product((0, -1, 1), repeat=COORDINATES)), np.int8)


@dataclass(frozen=True)
class Index:
    """Random directions and offsets (by table), the step and the number of cells that a query visits in each table."""

    directions: np.ndarray
    offsets: np.ndarray
    step: float
    probes: int

    @property
    def tables(self) -> int:
        return len(self.directions)

    @property
    def exact(self) -> bool:
        """Whether there is but one cell."""
        return not self.directions.any()

    def places(self, x: np.ndarray) -> np.ndarray:
        """Positions in steps: rows x tables x coordinates."""
        return np.einsum("nd,tdm->ntm", x, self.directions) / self.step + self.offsets

    def costs(self, places: np.ndarray, moves: np.ndarray) -> np.ndarray:
        """Sum of the squared distances to the walls that each move crosses, for one table."""
        inside = places - np.floor(places)
        return inside**2 @ (moves == -1).T.astype(float) + (1 - inside) ** 2 @ (moves == 1).T.astype(float)


def cell_keys(cells: np.ndarray) -> np.ndarray:
    """One long of eight small steps; steps beyond a byte share the outermost."""
    small = np.clip(cells, -127, 127).astype(np.int64) + 128
    return (small << (8 * np.arange(COORDINATES, dtype=np.int64))).sum(axis=-1)


def _unit_index(dims: int, step: float, probes: int) -> Index:
    rng = np.random.default_rng(SEED)
    return Index(rng.normal(size=(TABLES, dims, COORDINATES)), rng.random((TABLES, COORDINATES)), step, probes)


def one_cell(dims: int) -> Index:
    """One table with one cell that holds every vector: the search is exact."""
    return Index(np.zeros((1, dims, COORDINATES)), np.zeros((1, COORDINATES)), 1.0, 1)


def fit_index(sample: np.ndarray, neighbours: int) -> Index:
    """Step and probes with which the sample's queries meet TARGET_RECALL of their nearest ``neighbours``.

    ``neighbours`` in the sample are about as far away as the k nearest of the
    whole table.  Of the STEPS, that with the fewest candidates is taken.  If
    none meets the target, the step is doubled until one does; beyond the width
    of the sample one cell for everything is left.  So it is for tiny samples.
    """
    dims, moves = sample.shape[1], _moves()
    if len(sample) < 20:
        return one_cell(dims)
    asked = sample[: min(SAMPLE_QUERIES, len(sample) // 4)]
    gaps = np.array([np.sqrt(((sample - a) ** 2).sum(axis=1)) for a in asked])
    widest = float(gaps.max())
    gaps[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    nearest = np.argsort(gaps, axis=1, kind="stable")[:, :neighbours]
    reach = float(np.median(gaps.min(axis=1)))
    best, steps = None, [reach * factor for factor in STEPS]
    while steps and steps[-1] > 0 and np.isfinite(widest):
        step = steps.pop(0)
        index = _unit_index(dims, step, len(moves))
        places = index.places(sample)
        cells = np.floor(places)
        rank = np.full((len(asked), len(sample)), len(moves), int)  # probes until a row is met, over all tables
        for t in range(TABLES):
            order = np.argsort(np.argsort(index.costs(places[: len(asked), t], moves), axis=1), axis=1)
            for q in range(len(asked)):
                d = cells[:, t] - cells[q, t]
                near = np.abs(d).max(axis=1) <= 1
                # In _moves() the digits 0, 1, 2 stand for 0, -1, +1.
                digits = (-d[near].astype(int)) % 3
                code = (digits * 3 ** np.arange(COORDINATES - 1, -1, -1)).sum(axis=1)
                rank[q, near] = np.minimum(rank[q, near], order[q, code])
        met = np.sort(np.take_along_axis(rank, nearest, axis=1), axis=None)
        probes = int(met[min(len(met) - 1, int(np.ceil(TARGET_RECALL * len(met))) - 1)]) + 1
        share = float((rank < probes).mean())
        if probes <= len(moves) and (best is None or share < best[0]):
            best = (share, Index(index.directions, index.offsets, index.step, probes))
        if not steps and best is None and step <= 4 * widest:
            steps = [2 * step]
    return best[1] if best else one_cell(dims)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1) if n else np.empty((0, 0))


def _hash_rows(index: Index):
    def run(batches):
        for b in batches:
            keys = cell_keys(np.floor(index.places(_matrix(b.column(1))))) if b.num_rows else np.empty((0, index.tables), np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * index.tables, pa.array(keys.ravel(), pa.int64()))],
                ["vec_ids", "v", "cells"],
            )

    return run


def _probe_rows(index: Index):
    def run(batches):
        moves = _moves()
        for b in batches:
            ids, table, keys = [], [], []
            if b.num_rows:
                places = index.places(_matrix(b.column(1)))
                for i, q in enumerate(b.column(0).to_pylist()):
                    for t in range(index.tables):
                        cost = index.costs(places[i : i + 1, t], moves)[0]
                        first = np.argsort(cost, kind="stable")[: index.probes]
                        ids.append(np.full(len(first), q))
                        table.append(np.full(len(first), t))
                        keys.append(cell_keys(np.floor(places[i, t]) + moves[first]))
            done = lambda x: pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([done(ids), done(table), done(keys)], ["query_id", "tbl", "cell"])

    return run


def _rank_unit(k: int):
    """Vectors (unit, part, tbl, cell, vec_ids, v) and queries (unit, part, query_id, v, cells): each query's k nearest of the unit."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    most = (k + 1) * TABLES  # a vector may come from every table

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return schema.empty_table()
        x, q = _matrix(rows["v"]), _matrix(asked["v"])
        ids = rows["vec_ids"].to_pylist()
        names = list(zip(rows["tbl"].to_pylist(), rows["cell"].to_pylist(), rows["salt"].to_pylist()))
        where: dict = {}
        for i, name in enumerate(names):
            where.setdefault(name, []).append(i)
        where = {name: np.array(i) for name, i in where.items()}
        size = (x**2).sum(axis=1)
        out_q, out_v, out_s = [], [], []
        for qi, (query, visits) in enumerate(zip(asked["query_id"].to_pylist(), asked["visits"].to_pylist())):
            met = [where[n] for n in ((v["tbl"], v["cell"], v["salt"]) for v in visits) if n in where]
            if not met:
                continue
            at = np.unique(np.concatenate(met))
            # The expanded square finds who can be among the nearest; their distances are then taken directly.
            rough = size[at] - 2 * (x[at] @ q[qi])
            if len(at) > most:
                slack = 1e-9 * (size[at] + q[qi] @ q[qi])  # of rounding, whatever the scale of the vectors
                bound = np.partition(rough + slack, most - 1)[most - 1]
                at = at[rough - slack <= bound]
            exact = np.sqrt(((x[at] - q[qi]) ** 2).sum(axis=1))
            found = sorted((s, v) for s, i in zip(exact.tolist(), at.tolist()) for v in ids[i] if v != query)
            seen = list(dict.fromkeys(found))[:k]
            out_q += [query] * len(seen)
            out_v += [v for _, v in seen]
            out_s += [s for s, _ in seen]
        return pa.table([out_q, out_v, out_s], schema=schema)

    return run


def _search(hashed: DataFrame, asked: DataFrame, index: Index, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the k nearest entries of each unit that a query visits, by units of bounded size."""
    cells = hashed.select("vec_ids", "v", "h", F.posexplode("cells").alias("tbl", "cell")).withColumn("tbl", F.col("tbl").cast("long"))
    directory = store(
        cells.groupBy("tbl", "cell").agg(F.count("*").alias("n")).select(
            "tbl", "cell", F.ceil(F.col("n") / CELL_ROWS).alias("salts"), F.col("n")
        ),
        "ann-cells",
    )
    units = max(1, -(-(directory.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // UNIT_ROWS))
    parts = max(1, -(-asked.count() // UNIT_QUERIES))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts).cast("long"))
    unit = F.pmod(F.xxhash64("tbl", "cell", "salt"), F.lit(units)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    probes = asked.select("query_id", "v").mapInArrow(_probe_rows(index), "query_id LONG, tbl LONG, cell LONG")
    probes = store(probes.withColumn("part", part).join(directory, ["tbl", "cell"]), "ann-probes")
    # A row goes to the blocks of queries that visit its cell, and to no other.
    visited = store(probes.select("tbl", "cell", "salts", "part").distinct(), "ann-visited")
    left = (
        cells.join(visited, ["tbl", "cell"])
        .withColumn("salt", F.col("h") % F.col("salts"))
        .select(unit.alias("unit"), "part", "tbl", "cell", "salt", "vec_ids", "v")
    )
    visits = (
        probes.select("query_id", "tbl", "cell", each(F.col("salts")).alias("salt"))
        .select("query_id", unit.alias("unit"), F.struct("tbl", "cell", "salt").alias("visit"))
        .groupBy("query_id", "unit").agg(F.collect_list("visit").alias("visits"))
    )
    right = visits.join(asked, "query_id").select("unit", part.alias("part"), "query_id", "v", "visits")
    return left.groupBy("unit", "part").cogroup(right.groupBy("unit", "part")).applyInArrow(
        _rank_unit(k), "query_id LONG, vec_id LONG, score DOUBLE"
    )


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """The k nearest rows of ``vectors`` found for each of ``queries``: ``query_id, rank, vec_id, score``.

    ``score`` is the Euclidean distance in double precision, ties go to the
    smaller id, and a query's own id is no candidate.  Vectors that are null,
    empty, zero, of another length than most of the sample, or hold a null or
    non-finite component, and rows with a null id, take no part on either side;
    of repeated rows of one id one counts.  Of a queried id with several vectors
    the least asks.  An empty table gives no rows; other columns are not used.

    Equal vectors are one entry of the index with their k + 1 smallest ids, so
    a vector that a third of the rows have is compared once.  Large cells are
    split in parts and queries are grouped in blocks; a unit of work holds a
    bounded number of both.  Every row is indexed.  A query whose cells give
    fewer than k is compared with all entries, in the same units.
    """
    spark = vectors.sparkSession
    clean = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND exists(v, x -> x <> 0)"
        " AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('Infinity'))"
    )
    rows, asked = clean(vectors), clean(queries)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").collect()
    out = "query_id LONG, rank INT, vec_id LONG, score DOUBLE"
    if not sample:
        return spark.createDataFrame([], out)
    sizes = [len(r["v"]) for r in sample]
    dims = max(set(sizes), key=lambda n: (sizes.count(n), -n))
    known = np.unique(np.array([r["v"] for r in sample if len(r["v"]) == dims]), axis=0)
    rows, asked = rows.where(F.size("v") == dims), asked.where(F.size("v") == dims)
    asked = store(asked.groupBy(F.col("id").alias("query_id")).agg(F.min("v").alias("v")), "ann-queries")

    # The rank filter is applied before the shuffle too: a task sends k + 1 ids of a vector at most.
    least = rows.distinct().withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("nth") <= k + 1)
    distinct = least.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("vec_ids"))
    total = rows.count()
    if 2 * len(known) < len(sample) < total:  # mostly copies: a sample of the entries tells more
        distinct = store(distinct, "ann-entries")
        total = distinct.count()
        picked = distinct.orderBy(F.xxhash64("vec_ids"), F.col("vec_ids")[0]).limit(SAMPLE_ROWS).select("v").collect()
        known = np.unique(np.array([r["v"] for r in picked]), axis=0)
    share = min(1.0, SAMPLE_ROWS / total)
    index = fit_index(known[np.random.default_rng(SEED).permutation(len(known))], max(1, math.ceil(k * share)))
    hashed = distinct.select("vec_ids", "v").mapInArrow(_hash_rows(index), "vec_ids ARRAY<LONG>, v ARRAY<DOUBLE>, cells ARRAY<LONG>")
    hashed = store(hashed.withColumn("h", F.abs(F.xxhash64(F.col("vec_ids")[0]) % (1 << 40))), "ann-index")
    found = _search(hashed, asked, index, k)
    if not index.exact:
        found = store(found, "ann-found")
        full = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
        short = store(asked.join(full, "query_id", "left_anti"), "ann-short")
        if not short.isEmpty():
            everything = F.array(F.lit(int(cell_keys(np.zeros(COORDINATES)))))
            found = found.join(short, "query_id", "left_anti").unionByName(_search(hashed.withColumn("cells", everything), short, one_cell(dims), k))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
