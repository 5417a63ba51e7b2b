"""The order of documents and digests of spans, for both substring operators; fragments compared, for bytes.

A fragment is a run of windows that share a key which their content alone
decides.  Fragments with the same content are settled as wholes; only
different fragments of one key need a look inside.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ROW_KEY, store, with_row_key


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
ODD, UNDO = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: digest: null for a fragment that is settled (its key is then the document, to deal these out).
FRAGMENT = "gram LONG, digest LONG, ord LONG, start LONG, n LONG"
#: gram: null for a span that is settled; large: the group's windows are dealt out one by one.
VERDICT = "gram LONG, large BOOLEAN, ord LONG, start LONG, n LONG"
#: Rows of fragments that are compared at once; different fragments of one key above which their windows are dealt out.
CHUNK_ROWS = 1 << 18
LARGE_GROUP = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finisher: nearby inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the odd base and of its inverse modulo 2^64, made longer when a longer block comes."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            made = []
            for base in (ODD, UNDO):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                made.append(np.multiply.accumulate(p))
            cls.up, cls.down = made
        return cls.up, cls.down


def span_digests(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Digest of ``values[start:end]`` for every pair: a polynomial modulo 2^64, by prefix sums."""
    up, down = Powers.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def runs(follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, size) of maximal runs; ``follow[i]``: row i belongs with row i - 1."""
    first = np.flatnonzero(~follow)
    return first, np.diff(np.append(first, len(follow)))


def repeats(keys: list[np.ndarray], ords: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a row's keys also occur at an earlier (ord, start) of these rows."""
    order = np.lexsort((starts, ords, *reversed(keys)))
    same = np.ones(max(0, len(order) - 1), bool)
    for k in keys:
        k = k[order]
        same &= k[1:] == k[:-1]
    out = np.zeros(len(order), bool)
    out[order[1:]] = same
    return out


def columns(b: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in b.columns]


def verdicts(gram, ords, start, n, settled, large) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(gram, pa.int64(), mask=settled), pa.array(large), pa.array(ords), pa.array(start), pa.array(n)],
        ["gram", "large", "ord", "start", "n"],
    )


def compare_fragments(batches):
    """Fragments sorted by (gram, ord, start): settled spans, and fragments to be looked into.

    A fragment equal to an earlier one is settled whole.  If a gram has two
    different fragments, each of them (its first occurrence) is looked into.
    A group that doesn't end in this chunk is carried over without repeats.  Of
    a large one, whose verdicts are out, half a chunk at most is carried, to
    settle copies of these; copies of others are looked into, where their
    windows meet their twins by digest.  So a group of any size is streamed.
    """
    held: list[np.ndarray] | None = None

    def judge(gram, digest, ords, start, n, told, last):
        """(verdicts, rows carried over); ``told``: carried rows whose verdict is out already."""
        old = repeats([gram, digest, n], ords, start)
        new = ~old
        group = np.cumsum(np.concatenate([[True], gram[1:] != gram[:-1]])) - 1
        kinds = np.bincount(group, weights=new)[group]
        open_ = np.zeros(len(gram), bool) if last else group == group[-1]
        large = kinds > LARGE_GROUP
        # An open group is judged when it is complete, or at once when it is large.
        out = new & (kinds > 1) & ~told & (~open_ | large)
        give, keep = old | out, open_ & new
        keep = np.flatnonzero(keep)
        if len(keep) > LARGE_GROUP:
            keep = keep[: max(LARGE_GROUP + 1, CHUNK_ROWS // 2)]
        carried = [x[keep] for x in (gram, digest, ords, start, n, told | out)]
        return verdicts(gram[give], ords[give], start[give], n[give], old[give], large[give]), carried

    for b in batches:
        if not b.num_rows:
            continue
        loose = b.column(1).is_null().to_numpy(zero_copy_only=False)
        if loose.any():
            gram, ords, start, n = (c[loose] for c in columns(b.select(["gram", "ord", "start", "n"])))
            yield verdicts(gram, ords, start, n, np.ones(len(n), bool), np.zeros(len(n), bool))
        rest = b.filter(pa.array(~loose))
        if not rest.num_rows:
            continue
        cols = [*(c.astype(np.int64) for c in columns(rest)), np.zeros(rest.num_rows, bool)]
        held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
        if len(held[0]) >= CHUNK_ROWS:
            out, held = judge(*held, last=False)
            yield out
    if held is not None and len(held[0]):
        yield judge(*held, last=True)[0]



def fragment_verdicts(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(settled ``ord, start, n``; per document the ``parts`` to look into) of FRAGMENT rows.

    The verdicts are stored: what follows reads them twice.
    """
    dealt = rows.repartition("gram").sortWithinPartitions("gram", "ord", "start")
    judged = store(dealt.mapInArrow(compare_fragments, VERDICT), name)
    settled = judged.where("gram IS NULL").select("ord", "start", "n")
    asked = judged.where("gram IS NOT NULL").groupBy("ord")
    return settled, asked.agg(F.collect_list(F.struct("gram", "large", "start", "n")).alias("parts"))


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``ord, doc_id, text`` (UTF-8 bytes); ``ord`` is unique and rises with doc_id.

    Where doc_ids are null or repeated, rows are numbered by (doc_id, null
    last; row key) once and that number is the order; otherwise doc_id is.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    odd = rows.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if odd.isEmpty():
        return rows.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("ord"), "doc_id", "text")
    keyed = with_row_key(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), ROW_KEY
    )
    ranked = keyed.select("doc_id", ROW_KEY).orderBy(F.col("doc_id").isNull(), "doc_id", ROW_KEY)
    ranked = store(ranked.select(ROW_KEY, F.monotonically_increasing_id().alias("ord")), "document-order")
    return keyed.join(ranked, ROW_KEY).select("ord", "doc_id", "text")
