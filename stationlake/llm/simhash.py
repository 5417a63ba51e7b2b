"""SimHash near-dedup with a pigeonring candidate filter.

Fingerprints of 64 bits are cut into ``m = max_bits + 1`` segments on a ring.
If two fingerprints differ in ``n <= max_bits`` bits, some segment starts a
chain in which every run of ``l`` consecutive segments differs in at most
``l * max_bits / m`` bits together.  The first segment of such a chain is
therefore equal and the second differs in one bit at most, so one of its halves
is equal: (start, equal segment, equal half) is an equi-join key.  The whole
chain is tested before the Hamming distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ROW_KEY, store, with_row_key
from stationlake.llm.components import connected_components

BITS = 64
#: Buckets above this are cut again by a second key (an exact refinement).
LARGE_BUCKET = 1024
#: Shingles whose bits are counted at once.
BLOCK = 1 << 14


def fingerprint(raw: bytes | None, shingle_words: int, seed: int = 42) -> int:
    """SimHash of the word shingles of one UTF-8 text; no words: 0."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle_words + 1].tolist()
    ends = ends[shingle_words - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK], ends[at : at + BLOCK])
        h = np.array([digest(line[x:y], seed) for x, y in spans], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    on = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(on.view(np.uint64)[0])


def _fingerprints(shingle_words: int):
    def run(batches):
        for b in batches:
            made = [fingerprint(t, shingle_words) for t in b.column(0).to_pylist()]
            fp = pa.array(np.array(made, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), fp], ["doc_id", ROW_KEY, "fp"])

    return run


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    m = max_bits + 1
    widths = [BITS // m + (i < BITS % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _cut(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _halves(shift: int, width: int) -> list[tuple[int, int]]:
    return [(shift, width // 2), (shift + width // 2, width - width // 2)]


def chain_keys(fp: Column, max_bits: int) -> Column:
    """array<struct<start, key>>: for each start, its segment and either half of the next one."""
    segments = _segments(max_bits)
    keys = []
    for i, (shift, width) in enumerate(segments):
        for j, (s, w) in enumerate(_halves(*segments[(i + 1) % len(segments)])):
            key = F.shiftleft(_cut(fp, shift, width), w).bitwiseOR(_cut(fp, s, w))
            keys.append(F.struct(F.lit(i * 2 + j).alias("start"), key.alias("key")))
    return F.array(*keys)


def _gather(fp: Column, positions: list[int], tag: int) -> Column:
    """The bits of ``fp`` at ``positions`` side by side, with ``tag`` above them."""
    out = F.lit(tag << 40).cast("long")
    for j, x in enumerate(positions):
        out = out.bitwiseOR(F.shiftleft(_cut(fp, x, 1), j))
    return out


def _chained(x: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Whether differences ``x`` keep within every budget of the chain from segment ``start``."""
    segments, m = _segments(max_bits), max_bits + 1
    total, fits = np.zeros(x.shape, np.uint8), np.ones(x.shape, bool)
    for size in range(1, m + 1):
        shift, width = segments[(start + size - 1) % m]
        total = total + np.bitwise_count((x >> np.uint64(shift)) & np.uint64((1 << width) - 1))
        fits &= total <= size * max_bits // m
    return fits


def _near(x: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    fits = _chained(x, start, max_bits)
    fits[fits] = np.bitwise_count(x[fits]) <= max_bits
    return fits


def _spanning(values: np.ndarray, start: int, max_bits: int, out: list) -> None:
    """Links that connect what a bucket connects: a star for each part, not all pairs."""
    left = np.sort(values)
    while len(left) > 1:
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for one in front:
                hit |= _near(left ^ one, start, max_bits)
            front, left = left[hit], left[~hit]
            out.extend((int(root), int(x)) for x in front)


def _bucket_links(max_bits: int, large: int | None):
    """Rows (start, key, more, fp), sorted by the first three: links (a, b), and the rows of large buckets."""

    def run(batches):
        held_key, held, size = None, [], 0

        def close(links):
            if size > 1 and (large is None or size <= large):
                _spanning(np.concatenate(held), held_key[0] // 2, max_bits, links)

        def batch(links, rest):
            a = np.array([x for x, _ in links], np.uint64).view(np.int64)
            b = np.array([x for _, x in links], np.uint64).view(np.int64)
            n, k = len(links), len(rest)
            start = pa.array([None] * n + [r[0] for r in rest], pa.int32())
            key = pa.array([None] * n + [r[1] for r in rest], pa.int64())
            fp = np.array([r[2] for r in rest], np.int64)
            return pa.RecordBatch.from_arrays(
                [start, key, pa.array(np.concatenate([a, fp])), pa.array(np.concatenate([b, np.zeros(k, np.int64)]))],
                ["start", "key", "a", "b"],
            )

        for b in batches:
            if not b.num_rows:
                continue
            links, rest = [], []
            keys = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            fps = b.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            new = np.ones(len(fps), bool)
            new[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]) | (keys[2][1:] != keys[2][:-1])
            edges = [*np.flatnonzero(new).tolist(), len(fps)]
            for x, y in zip(edges, edges[1:]):
                key = (int(keys[0][x]), int(keys[1][x]), int(keys[2][x]))
                if key != held_key:
                    close(links)
                    held_key, held, size = key, [], 0
                part, size = fps[x:y], size + (y - x)
                if large is not None and size > large:
                    rest.extend((key[0], key[1], int(v)) for p in [*held, part] for v in p.view(np.int64))
                    held = []
                else:
                    held.append(part)
            if links or rest:
                yield batch(links, rest)
        links = []
        close(links)
        if links:
            yield batch(links, [])

    return run


def _in_buckets(rows: DataFrame, max_bits: int, large: int | None) -> DataFrame:
    dealt = rows.repartition("start", "key", "more").sortWithinPartitions("start", "key", "more")
    return dealt.mapInArrow(_bucket_links(max_bits, large), "start INT, key LONG, a LONG, b LONG")


def links_within(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links ``(a, b)`` that join every two of the distinct ``fp`` at ``max_bits`` or fewer differing bits.

    The links of a bucket are a star for each connected part, so their number
    follows the rows.  A bucket above LARGE_BUCKET is cut by a second key: of
    the bits that the first leaves free, cut in ``max_bits + 1`` parts, one is
    equal in any linked pair.  No pair is lost, and a bucket of the second cut
    can't hold more than the few values that its free bits allow.
    """
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    rows = fps.select("fp", F.explode(chain_keys(F.col("fp"), max_bits)).alias("k")).select(
        F.col("k.start").alias("start"), F.col("k.key").alias("key"), F.lit(0).cast("long").alias("more"), "fp"
    )
    found = store(_in_buckets(rows, max_bits, LARGE_BUCKET), "simhash-links")
    links = found.where("start IS NULL").select("a", "b")
    large = found.where("start IS NOT NULL").select("start", "key", F.col("a").alias("fp"))
    segments, cuts = _segments(max_bits), None
    for i, (shift, width) in enumerate(segments):
        for j, (s, w) in enumerate(_halves(*segments[(i + 1) % len(segments)])):
            fixed = {*range(shift, shift + width), *range(s, s + w)}
            free = [x for x in range(BITS) if x not in fixed]
            parts = [free[p :: max_bits + 1] for p in range(max_bits + 1)]
            cut = F.array(*(_gather(F.col("fp"), part, p) for p, part in enumerate(parts)))
            mine = F.col("start") == i * 2 + j
            cuts = F.when(mine, cut) if cuts is None else cuts.when(mine, cut)
    again = large.select("start", "key", F.explode(cuts).alias("more"), "fp")
    second = _in_buckets(again, max_bits, None).select("a", "b")
    return links.unionAll(second)


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``row_key, doc_id, fingerprint, component_id, stays``.

    ``fingerprint`` is 16 hex digits, ``component_id`` the smallest doc_id
    reachable over links of at most ``max_bits`` bits, itself included.  One
    row of each component ``stays``: that of the smallest doc_id.  Null, empty
    and blank texts have fingerprint zero and link like any other.  A null
    doc_id never names a component unless all of its doc_ids are null (then it
    is null).  Repeated rows are rows of the same component.  Texts are read
    whole; an empty table gives no rows; other columns of ``docs`` are not used.
    """
    keyed = with_row_key(docs, id_col, text_col).select(
        F.col(text_col).cast("binary").alias("text"), F.col(id_col).cast("long").alias("doc_id"), ROW_KEY
    )
    schema = "doc_id LONG, row_key STRUCT<file: LONG, row: LONG>, fp LONG"
    marked = store(keyed.mapInArrow(_fingerprints(shingle_words), schema), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW_KEY)
    distinct = store(marked.groupBy("fp").agg(F.min(first).alias("first")), "simhash-distinct")
    roots = connected_components(links_within(distinct.select("fp"), max_bits))
    rooted = store(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "simhash-roots",
    )
    firsts = store(rooted.groupBy("root").agg(F.min("first").alias("kept")), "simhash-groups")
    named = store(rooted.join(firsts, "root").select("fp", "kept"), "simhash-named")
    return marked.join(named, "fp").select(
        ROW_KEY,
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("kept.doc_id").alias("component_id"),
        (F.col(ROW_KEY) == F.col("kept.row_key")).alias("stays"),
    )
