"""Vector code compression: product codes trained on exact integers.

Vectors become integers and are cut into equal consecutive parts.  The points
of each part are sorted along a Hilbert curve and stored as flat blocks with
their least and greatest components (a box) and their sum.  In each round the
distances from a box to the codebook's entries leave a short list of entries
that may be nearest to any point of the block: where it has one entry the
block's count and sum go to it as they are, else its points are compared with
the listed entries in integer arithmetic.  The codebooks, PARTS x ENTRIES
entries, are all that the driver holds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import store, with_group_total

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Points of one block.
BLOCK = 1_024
#: Bits of a Hilbert index.
CURVE_BITS = 62


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``points`` (unsigned, below ``2**bits``), by the transpose form."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):  # undo the turns from the coarsest cube down
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
    index = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | (((x[i] ^ turn) >> b) & 1)
    return index


def _integers(dims: int):
    """Vectors as rows of 32-bit integers: floor(SCALE x component)."""

    def run(batches):
        for b in batches:
            flat = b.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(flat * SCALE).astype("<i4").reshape(b.num_rows, dims)
            out = pa.array([row.tobytes() for row in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), out], ["vec_id", "label", "ints"])

    return run


def _matrix(column: pa.Array, width: int, kind: str = "<i4") -> np.ndarray:
    """A binary column's values, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).astype(np.int64)


def _extremes(dims: int):
    """Least and greatest of each component over a task: (pos, lo, hi)."""

    def run(batches):
        lo = hi = None
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column("ints"), dims)
                lo = m.min(0) if lo is None else np.minimum(lo, m.min(0))
                hi = m.max(0) if hi is None else np.maximum(hi, m.max(0))
        if lo is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(lo), pa.array(hi)], ["pos", "lo", "hi"])

    return run


def _points(dims: int, parts: int, lo: np.ndarray, hi: np.ndarray):
    """Vectors to points: (part, place along the part's curve, vid, point)."""
    width = dims // parts
    along = min(width, CURVE_BITS)  # components beyond these don't take part in the order
    bits = max(1, min(16, CURVE_BITS // max(along, 1)))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            m = _matrix(b.column("ints"), dims)
            scaled = ((m - lo) * ((1 << bits) - 1)) // np.maximum(hi - lo, 1)
            for p in range(parts):
                cols = slice(p * width, (p + 1) * width)
                place = hilbert_index(scaled[:, cols][:, :along], bits) if along else np.zeros(len(m), np.int64)
                flat = [row.tobytes() for row in m[:, cols].astype("<i4")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(m), p, np.int32)), pa.array(place), b.column("vid"), pa.array(flat, pa.binary())],
                    ["part", "place", "vid", "point"],
                )

    return run


def _blocks(width: int, size: int):
    """Sorted points to flat blocks of at most ``size``: (part, n, lo, hi, total, vids, points)."""

    def block(part: int, vids: list, points: list) -> tuple:
        m = np.concatenate(points)
        one = lambda a, kind: a.astype(kind).tobytes()
        return part, len(m), one(m.min(0), "<i8"), one(m.max(0), "<i8"), one(m.sum(0), "<i8"), one(np.concatenate(vids), "<i8"), one(m, "<i4")

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "n", "lo", "hi", "total", "vids", "points"]
        )

    def run(batches):
        held, vids, points, n = None, [], [], 0
        for b in batches:
            rows = []
            part = b.column("part").to_numpy()
            vid = b.column("vid").to_numpy()
            m = _matrix(b.column("point"), width)
            at = 0
            while at < len(part):
                if n and (part[at] != held or n == size):
                    rows.append(block(held, vids, points))
                    vids, points, n = [], [], 0
                held = int(part[at])
                end = min(at + size - n, int(np.searchsorted(part, held, "right")))
                vids.append(vid[at:end])
                points.append(m[at:end])
                n += end - at
                at = end
            if rows:
                yield batch(rows)
        if n:
            yield batch([block(held, vids, points)])

    return run


def short_lists(lo: np.ndarray, hi: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box the entries that may be nearest to a point in it (blocks x entries, boolean).

    An entry is left out when the box lies wholly farther from it than the
    box's farthest corner lies from another; entries at equal distance stay, so
    that ties still go to the lower index.
    """
    below, above = lo[:, None, :] - entries, entries - hi[:, None, :]
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(2)
    most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(2)
    return least <= most.min(1, keepdims=True)


def nearest_of(points: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest listed entry, the lower index of equals."""
    distance = ((points[:, None, :] - entries[listed][None, :, :]) ** 2).sum(2)
    best = distance.argmin(1)  # the first of equals; ``listed`` ascends
    return listed[best], distance[np.arange(len(points)), best]


def _by_part(b: pa.RecordBatch, width: int, books: np.ndarray):
    """Per part in the batch: (part, rows, short lists)."""
    part = b.column("part").to_numpy()
    lo, hi = (_matrix(b.column(c), width, "<i8") for c in ("lo", "hi"))
    for p in np.unique(part).tolist():
        rows = np.flatnonzero(part == p)
        yield p, rows, short_lists(lo[rows], hi[rows], books[p])


def _sums(width: int, books: np.ndarray):
    """Blocks to one partial sum per entry and task: (part, entry, pos, n, total)."""
    parts, k = books.shape[:2]

    def run(batches):
        n, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for b in batches:
            count = b.column("n").to_numpy()
            for p, rows, lists in _by_part(b, width, books):
                alone = lists.sum(1) == 1
                where = lists.argmax(1)
                if alone.any():  # whole blocks, by what is stored of them
                    some = rows[alone]
                    np.add.at(n[p], where[alone], count[some])
                    np.add.at(total[p], where[alone], _matrix(b.column("total").take(pa.array(some)), width, "<i8"))
                for r, listed in zip(rows[~alone].tolist(), lists[~alone]):
                    m = np.frombuffer(b.column("points")[r].as_py(), "<i4").reshape(-1, width).astype(np.int64)
                    code, _ = nearest_of(m, books[p], np.flatnonzero(listed))
                    np.add.at(n[p], code, 1)
                    np.add.at(total[p], code, m)
        used = np.argwhere(n > 0)
        if len(used):
            at = np.repeat(used, width, axis=0)
            pos = np.tile(np.arange(width, dtype=np.int32), len(used))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at[:, 0].astype(np.int32)),
                    pa.array(at[:, 1].astype(np.int32)),
                    pa.array(pos),
                    pa.array(n[at[:, 0], at[:, 1]]),
                    pa.array(total[at[:, 0], at[:, 1], pos]),
                ],
                ["part", "entry", "pos", "n", "total"],
            )

    return run


def _codes(width: int, books: np.ndarray):
    """Blocks to points with their final entry: (vid, part, code, distance)."""

    def run(batches):
        for b in batches:
            for p, rows, lists in _by_part(b, width, books):
                for r, listed in zip(rows.tolist(), lists):
                    vids = np.frombuffer(b.column("vids")[r].as_py(), "<i8")
                    m = np.frombuffer(b.column("points")[r].as_py(), "<i4").reshape(len(vids), width).astype(np.int64)
                    code, distance = nearest_of(m, books[p], np.flatnonzero(listed))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(vids), pa.array(np.full(len(vids), p, np.int32)), pa.array(code.astype(np.int32)), pa.array(distance)],
                        ["vid", "part", "code", "distance"],
                    )

    return run


def train(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after ``rounds`` of assigning all points and moving each used entry to its points' mean, rounded down."""
    width = books.shape[2]
    for _ in range(rounds):
        partial = blocks.mapInArrow(_sums(width, books), "part INT, entry INT, pos INT, n LONG, total LONG")
        sums = partial.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        books = books.copy()
        for r in sums.collect():  # one row per component of a codebook
            books[r["part"], r["entry"], r["pos"]] = r["total"] // r["n"]
    return books


def finite_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, vec`` of the rows whose vector is there and finite throughout."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(
        vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), vectors[vector_col].cast("array<double>").alias("vec")
    )
    return rows.where(F.col("vec").isNotNull() & F.forall("vec", real))


def _empty(spark: SparkSession, vec_kind: str) -> DataFrame:
    return spark.createDataFrame([], f"vec_id {vec_kind}, code STRING, error LONG, label_error LONG, codebooks_sha256 STRING")


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(one row per kept vector: ``vec_id, code, error, label_error, codebooks_sha256``; the codebooks).

    ``code`` has two hex digits per part, ``error`` the squared distances
    summed over parts, ``label_error`` the errors of all vectors with the same
    label (null labels together).  The codebooks are parts x entries x width.

    Rows whose vector is null or holds a null or non-finite component have no
    row.  A codebook begins with the vectors of the ``entries`` smallest
    vec_ids (null last; of repeated ids the vector that is smaller byte by
    byte); with fewer vectors it has fewer entries.  Repeated rows are vectors of
    their own, ties go to the lower index.  All vectors must have one length, a
    multiple of ``parts``, and components small enough for distances in 64 bits,
    else ValueError.  An empty table gives no rows; other columns are not used.
    """
    spark = vectors.sparkSession
    kept = finite_vectors(vectors, id_col, vector_col, label_col)
    size = F.size("vec")
    reach = F.max(F.greatest(F.abs(F.array_max("vec")), F.abs(F.array_min("vec"))))
    n, least, dims, far = kept.agg(F.count(F.lit(1)), F.min(size), F.max(size), reach).first()
    if not n:
        return _empty(spark, dict(kept.dtypes)["vec_id"]), np.zeros((parts, 0, 0), np.int64)
    if least != dims or dims % parts:
        raise ValueError(f"vectors of {least} to {dims} components: one length, a multiple of {parts}, is asked for")
    if dims * (2 * (SCALE * (far or 0) + 1)) ** 2 >= 2**63:
        raise ValueError(f"components up to {far} are too large for squared distances in 64 bits")
    width = dims // parts
    kinds = dict(kept.dtypes)
    whole = kept.mapInArrow(_integers(dims), f"vec_id {kinds['vec_id']}, label {kinds['label']}, ints BINARY")
    rows = store(whole.withColumn("vid", F.monotonically_increasing_id()), "code-vectors")

    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    first = np.array([np.frombuffer(r[0], "<i4") for r in seeds], np.int64).reshape(len(seeds), dims)
    books = first.reshape(len(seeds), parts, width).transpose(1, 0, 2)
    spread = rows.mapInArrow(_extremes(dims), "pos INT, lo LONG, hi LONG").groupBy("pos").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    lo, hi = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for r in spread.collect():  # one row per component
        lo[r["pos"]], hi[r["pos"]] = r["lo"], r["hi"]

    points = rows.mapInArrow(_points(dims, parts, lo, hi), "part INT, place LONG, vid LONG, point BINARY")
    # vid is part of the range, so that one vector repeated many times is dealt out like any other.
    dealt = points.repartitionByRange("part", "place", "vid").sortWithinPartitions("part", "place", "vid")
    schema = "part INT, n INT, lo BINARY, hi BINARY, total BINARY, vids BINARY, points BINARY"
    blocks = store(dealt.mapInArrow(_blocks(width, block), schema), "code-blocks")
    books = train(blocks, books, rounds)

    found = blocks.mapInArrow(_codes(width, books), "vid LONG, part INT, code INT, distance LONG")
    of_part = [F.max(F.when(F.col("part") == p, F.col("code"))).alias(f"code_{p}") for p in range(parts)]
    coded = found.groupBy("vid").agg(F.sum("distance").alias("error"), *of_part)
    text = F.concat(*(F.lpad(F.lower(F.hex(f"code_{p}")), 2, "0") for p in range(parts)))
    coded = store(rows.select("vid", "vec_id", "label").join(coded.select("vid", "error", text.alias("code")), "vid"), "codes")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = with_group_total(coded, "label", "vid", "error", "label_error")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), books
