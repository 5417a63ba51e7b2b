"""Byte-level BPE encoding of whole texts by overlapping chunks, and decoding.

A text of at most one chunk is split into pre-tokens where it lies.  A longer
one is cut into chunks that each read some way into the next; the chunks are
dealt out and pre-tokenised in parallel, each as if a pre-token began at its
start.  The first boundary that a chunk and its left neighbour both find in the
text they share is where they resynchronise: what a pattern without look-behind
matches from there on depends on the text from there on alone, so the left
chunk's pre-tokens hold before it and the right chunk's after it.  Texts with a
seam that finds no such boundary (a pre-token longer than the overlap) are cut
again into chunks and overlaps eight times as long, until none is left.  The
pieces are then encoded chunk by chunk and put together per text.  Decoding
concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import functools
import heapq
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import ROW_KEY, store, with_row_key

#: Code points that a chunk owns, and that it reads beyond them.
CHUNK, OVERLAP = 32_768, 1_024
#: How much longer both are for texts with an unresolved seam.
GROWTH = 8
#: Code points from a pre-token's end that may have decided it; nearer to the end of what was read it is not sure.
LOOK_AHEAD = 4
#: Pre-tokens that a worker remembers before it forgets those not met again.
CACHE_PIECES = 150_000
#: Code points from which a pre-token is merged with a heap of our own.
LONG_PIECE = 512
#: Ids whose bytes are looked up together.
DECODED_AT_ONCE = 65_536
KEY = "STRUCT<file: LONG, row: LONG>"


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of every token: a line holds its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


@functools.lru_cache(maxsize=2)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all tokens' bytes one after another, first byte of each id, length of each id)."""
    ranks = read_ranks(path)
    lengths = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    data = b"".join(sorted(ranks, key=ranks.__getitem__))
    return np.frombuffer(data, np.uint8), np.cumsum(lengths) - lengths, lengths


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: neighbours of the lowest joint rank are joined first, the leftmost of equals.

    With a heap of (joint rank, position) it takes n log n for n bytes.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that begins at i ends
    before = list(range(-1, n - 1))
    joint: list[int | None] = [ranks.get(piece[i : i + 2]) if i + 1 < n else None for i in range(n)]
    heap = [(r, i) for i, r in enumerate(joint) if r is not None]
    heapq.heapify(heap)

    def renew(i: int) -> None:
        j = end[i]
        joint[i] = ranks.get(piece[i : end[j]]) if j < n else None
        if joint[i] is not None:
            heapq.heappush(heap, (joint[i], i))

    while heap:
        rank, i = heapq.heappop(heap)
        if joint[i] != rank:
            continue  # one of the two has been joined otherwise since
        j = end[i]
        joint[j] = None
        end[i] = end[j]
        if end[i] < n:
            before[end[i]] = i
        renew(i)
        if before[i] >= 0:
            renew(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class PieceEncoder:
    """Ids of pre-tokens as little-endian 32-bit bytes, remembered in a table of bounded size."""

    def __init__(self, path: str):
        self.ranks, self.new, self.old = read_ranks(path), {}, {}
        # Whatever it is given is one piece to it.
        self.library = tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=self.ranks, special_tokens={})

    def piece_ids(self, piece: str) -> list[int]:
        if len(piece) < LONG_PIECE:
            return self.library.encode_ordinary(piece)
        return merge_long(piece.encode(), self.ranks)

    def __call__(self, pieces: list[str]) -> bytes:
        if len(self.new) > CACHE_PIECES:
            self.old, self.new = self.new, {}
        for p in set(pieces).difference(self.new):
            if (known := self.old.get(p)) is None:
                ids = self.piece_ids(p)
                known = struct.pack(f"<{len(ids)}i", *ids)
            self.new[p] = known
        return b"".join(map(self.new.__getitem__, pieces))


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> PieceEncoder:
    """One to a worker, whose tasks take over what it remembers."""
    return PieceEncoder(path)


def _ids_column(encoded: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in encoded)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def _encode_whole(path: str, pattern: str):
    """Texts of one chunk: (row_key, doc_id, ids)."""

    def run(batches):
        encode, pieces = _encoder(path), regex.compile(pattern).findall
        for b in batches:
            for part in (b.slice(at, 128) for at in range(0, b.num_rows, 128)):
                ids = [encode(pieces(t or "")) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(ROW_KEY), part.column("doc_id"), _ids_column(ids)], [ROW_KEY, "doc_id", "ids"]
                )

    return run


def _cut(chunk: int, overlap: int):
    """Texts to chunks: (row_key, chunk, start, last, text); the last are those that read to the text's end."""

    def run(batches):
        for b in batches:
            keys = b.column(ROW_KEY)
            for r, text in enumerate(b.column("text").to_pylist()):
                starts = list(range(0, len(text), chunk))
                for at in range(0, len(starts), 64):
                    some = starts[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.take(pa.array([r] * len(some))),
                            pa.array([s // chunk for s in some], pa.int32()),
                            pa.array(some, pa.int32()),
                            pa.array([s + chunk + overlap >= len(text) for s in some]),
                            pa.array([text[s : s + chunk + overlap] for s in some]),
                        ],
                        [ROW_KEY, "chunk", "start", "last", "text"],
                    )

    return run


def boundaries(text: str, start: int, last: bool, find) -> list[int]:
    """Places in the whole text where a pre-token ends, and ``start``; only those that no unread text can move."""
    sure = start + len(text) - (0 if last else LOOK_AHEAD)
    ends = [start, *(start + m.end() for m in find(text))]
    while len(ends) > 1 and ends[-1] > sure:
        ends.pop()
    return ends


def _pretokenise(pattern: str, chunk: int, overlap: int):
    """Chunks with their boundaries, and those that they share with the chunk before and the chunk after."""

    def run(batches):
        find = regex.compile(pattern).finditer
        for b in (whole.slice(at, 64) for whole in batches for at in range(0, whole.num_rows, 64)):
            rows = zip(b.column("start").to_pylist(), b.column("last").to_pylist(), b.column("text").to_pylist())
            ends = [boundaries(text, start, last, find) for start, last, text in rows]
            starts = b.column("start").to_pylist()
            heads = [[e for e in found if e <= s + overlap] for s, found in zip(starts, ends)]
            tails = [[e for e in found if e >= s + chunk] for s, found in zip(starts, ends)]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ends, ints), pa.array(heads, ints), pa.array(tails, ints)],
                [*b.schema.names, "ends", "head", "tail"],
            )

    return run


def _encode_pieces(path: str):
    """Stitched chunks, of which the boundaries from ``since`` to ``until`` count: (row_key, chunk, ids)."""

    def run(batches):
        encode = _encoder(path)
        for b in (whole.slice(at, 64) for whole in batches for at in range(0, whole.num_rows, 64)):
            out = []
            rows = zip(*(b.column(c).to_pylist() for c in ("start", "text", "ends", "since", "until")))
            for start, text, ends, since, until in rows:
                mine = [e - start for e in ends if e >= since and (until is None or e <= until)]
                out.append(encode([text[x:y] for x, y in zip(mine, mine[1:])]))
            yield pa.RecordBatch.from_arrays([b.column(ROW_KEY), b.column("chunk"), _ids_column(out)], [ROW_KEY, "chunk", "ids"])

    return run


def _stitched(texts: DataFrame, pattern: str, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(chunks of ``texts`` with what they own after stitching, keys of texts with an unresolved seam)."""
    cut = texts.mapInArrow(_cut(chunk, overlap), f"{ROW_KEY} {KEY}, chunk INT, start INT, last BOOLEAN, text STRING")
    schema = f"{ROW_KEY} {KEY}, chunk INT, start INT, last BOOLEAN, text STRING, ends ARRAY<INT>, head ARRAY<INT>, tail ARRAY<INT>"
    found = store(
        cut.repartition(ROW_KEY, "chunk").mapInArrow(_pretokenise(pattern, chunk, overlap), schema), "bpe-chunks"
    )
    line = Window.partitionBy(ROW_KEY).orderBy("chunk")
    shared = F.array_intersect(F.lag("tail").over(line), F.col("head"))
    seams = found.select(ROW_KEY, "chunk", F.when(F.col("chunk") == 0, 0).otherwise(F.array_min(shared)).alias("since"))
    seams = store(seams, "bpe-seams")
    bounds = seams.withColumn("until", F.lead("since").over(line))
    open_keys = seams.where("since IS NULL").select(ROW_KEY).distinct()
    whole = found.drop("head", "tail").join(bounds, [ROW_KEY, "chunk"]).join(open_keys, ROW_KEY, "left_anti")
    return whole, open_keys


def _encode_long(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Texts of more than one chunk: (row_key, ids)."""
    parts = None
    while True:
        whole, open_keys = _stitched(texts, pattern, chunk, overlap)
        ids = whole.mapInArrow(_encode_pieces(path), f"{ROW_KEY} {KEY}, chunk INT, ids ARRAY<INT>")
        parts = ids if parts is None else parts.unionAll(ids)
        open_keys = store(open_keys, "bpe-open")
        if open_keys.isEmpty():
            break
        texts = store(texts.join(open_keys, ROW_KEY, "left_semi"), "bpe-texts")
        chunk, overlap = chunk * GROWTH, overlap * GROWTH
    # The ids of one text, which is one row to begin with.
    line = F.array_sort(F.collect_list(F.struct("chunk", "ids")))
    return parts.groupBy(ROW_KEY).agg(F.flatten(line["ids"]).alias("ids"))


def encode(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per document: ``row_key, doc_id, ids`` (an array of 32-bit ids, in order).

    ``path`` names a file of ranks that every executor can read, with all 256
    single bytes among them.  ``pattern`` must match at every place of a text,
    without looking behind, and its matches may not depend on more than
    LOOK_AHEAD code points past their end, nor past their start, as
    ``public_tokenizers.PATTERN`` does not.  Each match is encoded by itself;
    no string is a special token.

    Null and empty texts have no ids.  Texts are read whole whatever their
    length; a pre-token longer than any chunk ends up in one chunk.  Repeated
    rows and doc_ids, null ones among them, give a row each.  An empty table
    gives no rows; other columns of ``docs`` are not used.
    """
    path = path or default_path()
    keyed = with_row_key(docs, id_col, text_col).select(
        ROW_KEY, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    kind = dict(keyed.dtypes)["doc_id"]
    short = keyed.where(~is_long).mapInArrow(_encode_whole(path, pattern), f"{ROW_KEY} {KEY}, doc_id {kind}, ids ARRAY<INT>")
    long = keyed.where(is_long)
    ids = store(_encode_long(long.select(ROW_KEY, "text"), path, pattern, chunk, overlap), "bpe-long")
    return short.unionByName(long.select(ROW_KEY, "doc_id").join(ids, ROW_KEY))


def token_data(ids: np.ndarray, path: str) -> bytes:
    """The bytes of ``ids`` one after another, taken some ids at a time."""
    data, first, lengths = _token_bytes(path)
    out = []
    for at in range(0, len(ids), DECODED_AT_ONCE):
        some = ids[at : at + DECODED_AT_ONCE]
        size = lengths[some]
        ends = np.cumsum(size)
        out.append(data[np.arange(ends[-1]) + np.repeat(first[some] - (ends - size), size)].tobytes())
    return b"".join(out)


def _decode(path: str):
    def run(batches):
        lengths = _token_bytes(path)[2]
        for b in batches:
            for part in (b.slice(at, 128) for at in range(0, b.num_rows, 128)):
                column = part.column("ids")
                ids = column.flatten().to_numpy(zero_copy_only=False)
                raw = token_data(ids, path)
                count = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                edge = np.concatenate([[0], np.cumsum(lengths[ids])])[np.concatenate([[0], np.cumsum(count)])].tolist()
                out = [raw[x:y] for x, y in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*part.schema.names, "data"])

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``data``: the bytes of its ``ids`` one after another (null and no ids: none).

    Other columns pass through; one named ``data`` is replaced.  An id beyond
    the ranks fails the job.
    """
    rows = encoded.drop("data")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", data BINARY"
    return rows.mapInArrow(_decode(path or default_path()), ddl)
