"""Substring dedup over bytes by merging Burrows-Wheeler transforms.

Equal strings of 100 bytes contain the same least 40-byte gram at the same
place, so fragments (runs of windows with one least gram) are dealt out by it,
and only fragments whose gram occurs in another, different fragment can hide a
repeat that is not a whole fragment.  These are sorted as shards: each shard's
suffixes are sorted once and give its transform; the transforms are merged by
refining the interleave of their rows symbol by symbol, which never sorts a
suffix again.  Where the interleave splits gives the common prefixes; rows that
are together after 100 bytes are a repeated interval, whose earliest member
stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.spans import (
    FRAGMENT,
    ODD,
    columns,
    fragment_verdicts,
    in_order,
    mix,
    repeats,
    runs,
    span_digests,
)

WINDOW = 100
GRAM = 40
#: Bytes of a symbol of the transforms; divides WINDOW.
SYMBOL = 4
#: Bytes of text that fragments are made of at once.
BLOCK_BYTES = 2 << 20
#: Bytes of fragments merged at once, and into how many shards they are cut.
MERGE_BYTES = 1 << 17
SHARDS = 4
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))
_POS = 24  # bits for the place in a block


def gram_digests(h: np.ndarray, size: int) -> np.ndarray:
    """Digest of every ``size`` consecutive entries, from digests of 1, 2, 4, ... entries."""
    by = {1: h}
    k = 1
    while k * 2 <= size:
        by[2 * k] = by[k][:-k] * np.uint64(pow(ODD, k, 1 << 64)) + by[k][k:]
        k *= 2
    out, have = by[k], k
    while have < size:
        k = 1 << ((size - have).bit_length() - 1)
        n = len(h) - have - k + 1
        out = out[:n] * np.uint64(pow(ODD, k, 1 << 64)) + by[k][have : have + n]
        have += k
    return mix(out)


def sliding_min(v: np.ndarray, size: int) -> np.ndarray:
    k, m = 1, v
    while k * 2 <= size:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    n = len(v) - size + 1
    return np.minimum(m[:n], m[size - k : size - k + n])


def _pieces(texts: list[bytes], ords: list[int], most: int):
    """Blocks of (bytes, ord, first position): texts, or overlapping parts of texts longer than ``most``."""
    part, size = [], 0
    for t, o in zip(texts, ords):
        for at in range(0, max(1, len(t) - WINDOW + 1), most):
            p = t[at : at + most + WINDOW - 1]
            if len(p) >= WINDOW:
                part.append((p, o, at))
                size += len(p)
            if size >= most:
                yield part
                part, size = [], 0
    if part:
        yield part


def fragments(block: list[tuple[bytes, int, int]]) -> tuple[np.ndarray, ...]:
    """(gram, digest, ord, start, windows) of every fragment of the block's texts (WINDOW bytes or more each)."""
    buf = np.frombuffer(b"".join(t for t, _, _ in block), np.uint8)
    sizes = np.array([len(t) for t, _, _ in block], np.int64)
    ords, begins = (np.array([x[i] for x in block], np.int64) for i in (1, 2))
    h = _BYTE[buf]
    grams = gram_digests(h, GRAM)
    low = np.uint64((1 << _POS) - 1)
    least = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), WINDOW - GRAM + 1)
    place = (least & low).astype(np.int64)
    ends = np.cumsum(sizes)
    inside = np.zeros(len(place), bool)
    for e, n in zip((ends - sizes).tolist(), sizes.tolist()):
        inside[e : e + n - WINDOW + 1] = True
    at = np.flatnonzero(inside)
    place = place[at]
    follow = np.zeros(len(at), bool)
    follow[1:] = (place[1:] == place[:-1]) & (at[1:] == at[:-1] + 1)
    first, n = runs(follow)
    start = at[first]
    digest = span_digests(h, start, start + n + WINDOW - 1)
    own = np.searchsorted(ends, start, side="right")
    return grams[place[first]], digest, ords[own], start - (ends - sizes)[own] + begins[own], n


def _fragment_rows(batches):
    """Fragments; of equal ones in a block all but the first are settled (digest null, dealt by document)."""
    for b in batches:
        for block in _pieces([t or b"" for t in b.column(0).to_pylist()], b.column(1).to_pylist(), BLOCK_BYTES):
            gram, digest, ords, start, n = fragments(block)
            old = repeats([gram, digest, n], ords, start)
            key = np.where(old, ords, gram.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(digest.view(np.int64), mask=old), pa.array(ords), pa.array(start), pa.array(n)],
                ["gram", "digest", "ord", "start", "n"],
            )


def _cut_rows(batches):
    """Rows to be merged (key gram, the fragment's bytes) or, for large groups, each window (key its digest, no bytes)."""
    for b in batches:
        keys, ords, starts, data = [], [], [], []
        for raw, o, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            for p in parts:
                piece = raw[p["start"] : p["start"] + p["n"] + WINDOW - 1]
                if p["large"]:
                    h = gram_digests(_BYTE[np.frombuffer(piece, np.uint8)], WINDOW).view(np.int64)
                    keys.append(h)
                    ords.append(np.full(len(h), o))
                    starts.append(p["start"] + np.arange(len(h)))
                    data += [None] * len(h)
                else:
                    keys.append([p["gram"]])
                    ords.append([o])
                    starts.append([p["start"]])
                    data.append(piece)
        joined = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (keys, ords, starts)]
        yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in joined), pa.array(data, pa.binary())], ["key", "ord", "start", "piece"])


def _symbols(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, piece of each, byte of each): a piece is read from each of its first SYMBOL bytes on, 0 ends a string."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    buf = np.frombuffer(b"".join(pieces) + b"\0" * SYMBOL, np.uint8).astype(np.uint32)
    total = int(sizes.sum())
    word = buf[:total]
    for j in range(1, SYMBOL):
        word = (word << np.uint32(8)) | buf[j : total + j]
    counts = (sizes[:, None] - np.arange(SYMBOL)) // SYMBOL
    begins = np.cumsum(counts.ravel() + 1).reshape(counts.shape) - counts - 1
    piece = np.repeat(np.arange(len(pieces)), sizes)
    at = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = at + SYMBOL <= sizes[piece]
    piece, at, word = piece[inside], at[inside], word[inside]
    where, ends = begins[piece, at % SYMBOL] + at // SYMBOL, begins + counts
    text, owner, place = (np.zeros(int(counts.sum()) + counts.size, np.int64) for _ in range(3))
    text[where], owner[where], place[where] = word.astype(np.int64) + 1, piece, at
    owner[ends] = np.arange(len(pieces))[:, None]
    place[ends] = np.arange(SYMBOL) + SYMBOL * counts
    return text, owner, place


def sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array of strings that end in 0, by prefix doubling; equal suffixes are in the order of their strings."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # symbols before the end
    rank, k = text, 1
    while True:
        then = np.where(left >= k, rank[np.minimum(np.arange(n) + k, n - 1)], 0)
        if max(rank.max(), then.max()) < 1 << 16:  # short keys are sorted by counting
            order = np.argsort(then.astype(np.uint16), kind="stable")
            order = order[np.argsort(rank.astype(np.uint16)[order], kind="stable")]
        else:
            order = np.lexsort((then, rank))
        first, second = rank[order], then[order]
        dense = np.empty(n, np.int64)
        dense[order] = np.cumsum(np.concatenate([[False], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        rank, k = dense, 2 * k
        if k > left.max() or dense[order[-1]] + 1 == n:
            return order


def merge_transforms(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each row, first rows of the intervals) after ``rounds`` symbols.

    ``transforms``: for each shard the symbol before each of its sorted
    suffixes, 0 at the start of a string (as many as strings).  Row r of a
    shard is its r-th in the interleave.  A round puts each row's symbol in
    front: rows go to the symbol's part of the next interleave in the order
    they have in this one; strings' ends stay in front.  Rows part when their
    symbols differ or what follows had parted before.
    """
    z = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    ahead = np.repeat(np.arange(len(transforms), dtype=np.uint8), [int((t == 0).sum()) for t in transforms])
    every = np.concatenate(transforms)
    narrow = np.uint16 if len(every) == 0 or every.max() < 1 << 16 else np.uint32
    every = every.astype(narrow)
    parted = np.zeros(len(z), bool)
    parted[:1] = True
    symbol = np.empty(len(z), narrow)
    for _ in range(rounds):
        symbol[np.argsort(z, kind="stable")] = every
        order = np.argsort(symbol, kind="stable")[len(ahead) :]
        interval = np.cumsum(parted, dtype=np.int32)[order]
        c = symbol[order]
        now = np.ones(len(z), bool)
        now[len(ahead) + 1 :] = (c[1:] != c[:-1]) | (interval[1:] != interval[:-1])
        z = np.concatenate([ahead, z[order]])
        if np.array_equal(now, parted):  # nothing parts any more: the strings are equal to their ends
            break
        parted = now
    return z, parted


def repeated_windows(pieces: list[bytes], shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, byte, interval) of every window of the pieces, in rows of equal windows together."""
    text, owner, place = _symbols(pieces)
    text = np.unique(text, return_inverse=True)[1]  # 0 stays 0, the order stays
    sizes = np.array([len(p) for p in pieces])
    cuts = [len(pieces) * i // shards for i in range(shards + 1)]
    transforms, suffixes = [], []
    for x, y in zip(cuts, cuts[1:]):
        if x == y:
            continue
        rows = slice(*np.searchsorted(owner, [x, y]))
        part = text[rows]
        sa = sorted_suffixes(part)
        before = np.concatenate([[0], part[:-1]])[sa]
        transforms.append(before)
        suffixes.append(sa + rows.start)
    z, parted = merge_transforms(transforms, WINDOW // SYMBOL)
    at = np.empty(len(z), np.int64)
    at[np.argsort(z, kind="stable")] = np.concatenate(suffixes)
    interval = np.cumsum(parted)
    whole = place[at] + WINDOW <= sizes[owner[at]]
    return owner[at][whole], place[at][whole], interval[whole]


def _merge(batches):
    """Rows sorted by (key, ord, start): spans that a window with an earlier twin covers."""
    pieces, keys, ords, starts, held, last = [], [], [], [], 0, None

    def spans(ords, at):
        order = np.lexsort((at, ords))
        ords, at = ords[order], at[order]
        follow = np.zeros(len(at), bool)
        follow[1:] = (ords[1:] == ords[:-1]) & (at[1:] == at[:-1] + 1)
        first, size = runs(follow)
        return pa.RecordBatch.from_arrays(
            [pa.array(ords[first]), pa.array(at[first]), pa.array(at[first] + size + WINDOW - 1)], ["ord", "lo", "hi"]
        )

    def flush():
        piece, place, interval = repeated_windows(pieces)
        o, at = np.array(ords, np.int64)[piece], np.array(starts, np.int64)[piece] + place
        gone = repeats([interval], o, at)
        return spans(o[gone], at[gone])

    for b in batches:
        if not b.num_rows:
            continue
        single = b.column(3).is_null().to_numpy(zero_copy_only=False)
        if single.any():
            key, o, at = (c[single].astype(np.int64) for c in columns(b.select(["key", "ord", "start"])))
            gone = np.zeros(len(key), bool)
            gone[1:] = key[1:] == key[:-1]
            gone[0] = last is not None and key[0] == last
            last = key[-1]
            yield spans(o[gone], at[gone])
        for key, o, at, piece in zip(*(c.to_pylist() for c in b.filter(pa.array(~single)).columns)):
            if held >= MERGE_BYTES and keys[-1] != key:
                yield flush()
                pieces, keys, ords, starts, held = [], [], [], [], 0
            pieces.append(piece)
            keys.append(key)
            ords.append(o)
            starts.append(at)
            held += len(piece)
    if pieces:
        yield flush()


def covered_spans(ordered: DataFrame) -> DataFrame:
    """``ord, lo, hi``: bytes lo to hi (exclusive) covered by strings of WINDOW bytes with an earlier twin."""
    rows = ordered.select("text", "ord").mapInArrow(_fragment_rows, FRAGMENT)
    settled, asked = fragment_verdicts(rows, "fragments")
    settled = settled.select("ord", F.col("start").alias("lo"), (F.col("start") + F.col("n") + WINDOW - 1).alias("hi"))
    # The same columns as in the last join of the texts, so that they are shuffled once for both.
    cut = ordered.join(asked.hint("merge"), "ord").select("text", "ord", "parts", "doc_id")
    cut = cut.mapInArrow(_cut_rows, "key LONG, ord LONG, start LONG, piece BINARY")
    merged = cut.repartition("key").sortWithinPartitions("key", "ord", "start").mapInArrow(_merge, "ord LONG, lo LONG, hi LONG")
    return settled.unionByName(merged)


def _apply(batches):
    for b in batches:
        sizes, removed, runs, texts = [], [], [], []
        for raw, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            raw = raw or b""
            kept, end, gone, n = [], 0, 0, 0
            for lo, hi in sorted((x["lo"], x["hi"]) for x in spans or ()):
                if n == 0 or lo > end:
                    kept.append(raw[end:lo])
                    n, end = n + 1, lo
                if hi > end:
                    gone, end = gone + hi - end, hi
            kept.append(raw[end:])
            sizes.append(len(raw))
            removed.append(gone)
            runs.append(n)
            texts.append(b"".join(kept))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(texts, pa.binary())],
            ["ord", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_text"],
        )


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``ord, doc_id, n_bytes, n_removed, n_spans, kept_text`` (bytes).

    A byte of a text's UTF-8 form is removed when a string of WINDOW bytes
    covers it that also starts earlier: in a document with a smaller doc_id, or
    earlier in the same one.  Strings never cross documents, may overlap, and
    are judged on the input.  ``n_spans`` counts the maximal removed runs.  A
    null text is empty; texts under WINDOW bytes lose nothing.  Rows with a null
    doc_id come last, repeated doc_ids in the order of their rows.  An empty
    table gives no rows; other columns are not used.

    Whole texts are read.  Copies of a fragment are one fragment (the earliest)
    before anything is merged; a gram with more than ``spans.LARGE_GROUP``
    different fragments is dealt out by window.  One task streams the fragments
    of a gram (not their bytes) and holds a bounded number of them.
    """
    ordered = in_order(docs, id_col, text_col)
    spans = covered_spans(ordered).groupBy("ord").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    whole = ordered.join(spans.hint("merge"), "ord", "left").select("ord", "doc_id", "text", "spans")
    return whole.mapInArrow(_apply, "ord LONG, doc_id LONG, n_bytes LONG, n_removed LONG, n_spans LONG, kept_text BINARY")
