"""Packing token sequences into windows by non-negative least squares.

Whole windows of long documents go as they are.  What is left of each document
is shorter than a window; only the histogram of these lengths (at most one
entry per length) reaches the driver.  Shallow combinations of lengths that
fill a window exactly are the columns of a least-squares problem whose solution
says how often to repeat each; rounded counts are laid out first and the
residual histogram is packed greedily, with cuts.  The layout says which ranks
of each length class go where, and Spark deals the documents out by it.
"""

from __future__ import annotations

import bisect
import functools
import os
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import ROW_KEY, store, with_row_key

WINDOW = 2048
END_ID = 1
#: Words, and parts of words, that a worker takes in before it forgets the ones not met again.
CACHE_WORDS, CACHE_PARTS = 250_000, 400_000
#: Partner lengths, the commonest, tried per length when triples are enumerated; what no triple fills is packed greedily.
PARTNERS = 24
#: Rows that are ranked together.
RANK_BLOCK = 50_000
KEY = "STRUCT<file: LONG, row: LONG>"


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _is_letters(word: str) -> bool:
    """Whether ``word`` is all letters, also in lower case: a dotted capital I becomes a letter and a combining mark."""
    return word.isalpha() and word.lower().isalpha()


class _Recent:
    """A bounded memory: entries not asked for during a whole generation are forgotten."""

    def __init__(self, entries: int):
        self.entries, self.new, self.old = entries, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Keys to be filled in; those of the last generation are taken over."""
        out, new, old = [], self.new, self.old
        for k in keys.difference(new):
            if (found := old.get(k)) is None:
                out.append(k)
            else:
                new[k] = found
        return out

    def turn(self) -> None:
        """Between texts: begin a generation when this one is full."""
        if len(self.new) > self.entries:
            self.old, self.new = self.new, {}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins what it separates, so the
    ids of a text are the ids of its words one after another.  Letters and the
    punctuation after them are separate to it as well, so a word of this form is
    made of two remembered parts; other words are encoded as they are.
    """

    #: Marks that only ever stand for themselves (no contraction, no special token).
    MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"

    def __init__(self, path: str, end_id: int):
        # A task has one core; the library's own threads would spin on the others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.model = self.tokenizer.model
        suffix = self.model.end_of_word_suffix
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        plain = ["a", "tokens", "thereabouts", "zqxjkvb"]
        whole = [e.ids for e in self.tokenizer.encode_batch(plain, add_special_tokens=False)]
        self.lowers = self.tokenizer.encode("ÀB", add_special_tokens=False).ids == self.tokenizer.encode("àb", add_special_tokens=False).ids
        self.direct = [[t.id for t in self.model.tokenize(w)] for w in plain] == whole
        self.words, self.parts = _Recent(CACHE_WORDS), _Recent(CACHE_PARTS)

    def _encode(self, parts: list[str]) -> None:
        """Remember the ids of ``parts``.

        Lower-case ASCII letters pass the tokenizer's normaliser and splitter
        as they are, so its model takes them directly (checked on a few words
        when the encoder is made); all else goes through the whole tokenizer.
        """
        single, plain, known = [], [], self.parts.new
        for p in parts:
            if not p.isalpha() or not (p.isascii() or _is_letters(p)):
                single.append(p)
            elif self.direct and p.isascii() and p.islower():
                known[p] = array("I", [t.id for t in self.model.tokenize(p)]).tobytes()
            else:
                plain.append(p)
        for at in range(0, len(plain), 1024):  # words of letters in one text; the last id of a word closes it
            some = plain[at : at + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):
                single += some
                continue
            data, ends = ids.tobytes(), (4 * ends).tolist()
            known.update(zip(some, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        for w, e in zip(single, self.tokenizer.encode_batch_fast(single, add_special_tokens=False) if single else ()):
            known[w] = array("I", e.ids).tobytes()

    def __call__(self, text: str | None) -> bytes:
        text = (text or "").replace("\n", " ")
        # Else left to the tokenizer: other alphabets have case rules by context, special tokens are met in raw text.
        if self.lowers and "<|" not in text and _is_latin(text):
            text = text.lower()
        words = text.split(" ")
        self.words.turn()
        self.parts.turn()
        if missing := self.words.missing(set(words)):
            cut = {}
            for w in missing:
                core = w.rstrip(self.MARKS)
                if core.isalpha() and (core.isascii() or _is_letters(core)):
                    cut[w] = (core, w[len(core) :])
                else:
                    cut[w] = (w, "")
            self._encode(self.parts.missing({part for pair in cut.values() for part in pair}))
            known = self.parts.new
            for w, (core, tail) in cut.items():
                self.words.new[w] = known[core] + known[tail]
        return b"".join(map(self.words.new.__getitem__, words)) + self.end


@functools.lru_cache(maxsize=2)
def _encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def _tokenized(path: str, end_id: int):
    def run(batches):
        encode = _encoder(path, end_id)
        for b in batches:
            for part in (b.slice(at, 512) for at in range(0, b.num_rows, 512)):
                ids = [encode(t) for t in part.column(0).to_pylist()]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array(n), pa.array(ids, pa.binary())],
                    [ROW_KEY, "doc_id", "doc_tokens", "ids"],
                )

    return run


def combinations(lengths: list[int], counts: dict[int, int], window: int) -> list[tuple[int, ...]]:
    """Pairs and triples of present lengths whose sum is the window."""
    found = {(a, window - a) for a in lengths if a >= window - a and counts.get(window - a)}
    common = sorted(lengths, key=lambda x: (-counts[x], x))[:PARTNERS]
    for a in lengths:
        for b in common:
            c = window - a - b
            if c > 0 and counts.get(c):
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found, reverse=True)


def repeat_counts(patterns: list[tuple[int, ...]], counts: dict[int, int], window: int, rounds: int = 400) -> np.ndarray:
    """x >= 0 with the least squared difference between its use of lengths and the histogram.

    Accelerated projected gradient; a column holds at most three entries.
    """
    rows = np.array([x for p in patterns for x in p])
    cols = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    target = np.zeros(window + 1)
    for x, n in counts.items():
        target[x] = n
    use = lambda x: np.bincount(rows, weights=x[cols], minlength=window + 1)
    v = np.ones(len(patterns))
    for _ in range(30):  # the step from the largest eigenvalue
        v = np.bincount(cols, weights=use(v)[rows], minlength=len(patterns))
        size = np.linalg.norm(v)
        v /= size
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        slope = np.bincount(cols, weights=(use(y) - target)[rows], minlength=len(patterns))
        step = np.maximum(0.0, y - slope / size)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = step + (before - 1) / t * (step - x)
        x = step
    return x


class _Pool:
    """Pieces not yet placed: for each length, ranges of ranks of a class, with the start in the rest."""

    def __init__(self, counts: dict[int, int]):
        self.ranges = {n: [(n, 0, c, 0)] for n, c in counts.items() if n and c}
        self.counts = {n: c for n, c in counts.items() if n and c}
        self.lengths = sorted(self.counts)

    def add(self, length: int, ranges: list) -> None:
        if length not in self.counts:
            bisect.insort(self.lengths, length)
            self.counts[length], self.ranges[length] = 0, []
        self.ranges[length].extend(ranges)
        self.counts[length] += sum(hi - lo for _, lo, hi, _ in ranges)

    def take(self, length: int, n: int) -> list:
        out, self.counts[length] = [], self.counts[length] - n
        while n:
            cls, lo, hi, start = self.ranges[length].pop()
            k = min(n, hi - lo)
            out.append((cls, lo, lo + k, start))
            if lo + k < hi:
                self.ranges[length].append((cls, lo + k, hi, start))
            n -= k
        if not self.counts[length]:
            del self.counts[length], self.ranges[length]
            self.lengths.remove(length)
        return out


def layout(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], int]:
    """(rows ``class, lo, hi, start, length, sequence, offset``, number of sequences).

    ``counts``: documents by what is left of them (0 < length < window).  The
    member of rank r in [lo, hi) of a class has its piece in sequence
    ``sequence + r - lo``.  Every sequence is full, but for the last tokens:
    they are cut into sequences whose lengths are powers of two.
    """
    pool, plan, made = _Pool(counts), [], 0

    def place(parts: list[tuple[int, int, int]], times: int) -> None:
        """parts: (length in the pool, offset, length of the piece)."""
        nonlocal made
        rest = []
        for length, offset, size in parts:
            at = made
            for cls, lo, hi, start in pool.take(length, times):
                plan.append((cls, lo, hi, start, size, at, offset))
                at += hi - lo
                if size < length:
                    rest.append((length - size, (cls, lo, hi, start + size)))
        for length, kept in rest:
            pool.add(length, [kept])
        made += times

    patterns = combinations(pool.lengths, pool.counts, window)
    if patterns:
        solved = repeat_counts(patterns, pool.counts, window)
        for i in np.argsort(-solved, kind="stable").tolist():
            p = patterns[i]
            most = min(pool.counts.get(x, 0) // p.count(x) for x in set(p))
            if times := min(int(solved[i] + 1e-6), most):
                place([(x, sum(p[:j]), x) for j, x in enumerate(p)], times)
    while pool.lengths:
        used: dict[int, int] = defaultdict(int)
        parts, space = [], window
        while space:
            at = bisect.bisect_right(pool.lengths, space) - 1
            while at >= 0 and used[pool.lengths[at]] >= pool.counts[pool.lengths[at]]:
                at -= 1
            if at < 0:  # none fits whole: cut the longest
                at = len(pool.lengths) - 1
                while at >= 0 and used[pool.lengths[at]] >= pool.counts[pool.lengths[at]]:
                    at -= 1
                if at < 0:
                    break
            length = pool.lengths[at]
            # As often as it fits at once, so that short pieces don't take a step each.
            for _ in range(max(1, min(space // length, pool.counts[length] - used[length]))):
                used[length] += 1
                parts.append((length, window - space, min(length, space)))
                space -= parts[-1][2]
        if not space:
            place(parts, min(pool.counts[x] // n for x, n in used.items()))
            continue
        total, tail = window - space, []
        for length, offset, size in parts:
            for cls, lo, hi, start in pool.take(length, 1):
                tail.append((cls, lo, hi, start, size, offset))
        begin = 0
        for bit in reversed(range(total.bit_length())):
            if total >> bit & 1:
                end = begin + (1 << bit)
                for cls, lo, hi, start, size, offset in tail:
                    x, y = max(begin, offset), min(end, offset + size)
                    if x < y:
                        plan.append((cls, lo, hi, start + x - offset, y - x, made, x - begin))
                begin, made = end, made + 1
    return plan, made


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``row_key, doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    A document is its ids and then ``end_id``; a null or empty text is that id
    alone.  Each id lies in exactly one piece; a sequence holds at most
    ``window`` ids, gapless from 0.  ``ids`` are the piece's ids as
    little-endian unsigned 32-bit bytes.  Null or repeated doc_ids don't
    matter (rows are told apart by ``row_key``); an empty table gives no rows;
    other columns of ``docs`` are not used.

    Tokens are stored once.  Ranks are given in blocks of about RANK_BLOCK rows,
    so a length that a third of the documents have is ranked by many tasks.
    The driver sees the histogram and the layout, bounded by the window.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    keyed = with_row_key(docs, id_col, text_col).select(text_col, ROW_KEY, F.col(id_col).cast("long").alias("doc_id"))
    schema = f"row_key {KEY}, doc_id LONG, doc_tokens LONG, ids BINARY"
    tokens = store(keyed.mapInArrow(_tokenized(path, end_id), schema), "tokens")
    sizes = tokens.select(
        ROW_KEY, F.pmod("doc_tokens", F.lit(window)).cast("int").alias("cls"), F.expr(f"doc_tokens div {window}").alias("full")
    )
    histogram = {r["cls"]: (r["n"], r["full"]) for r in sizes.groupBy("cls").agg(F.count("*").alias("n"), F.sum("full").alias("full")).collect()}
    plan, made = layout({k: n for k, (n, _) in histogram.items() if k}, window)
    bases, base = [], made
    for cls, (n, full) in sorted(histogram.items()):
        bases.append((cls, -(-n // RANK_BLOCK), base))
        base += full
    # At most one row per length.
    classes = F.broadcast(spark.createDataFrame(bases, "cls INT, salts LONG, full_base LONG"))
    salted = sizes.join(classes, "cls").withColumn("salt", F.pmod(F.xxhash64(ROW_KEY), F.col("salts")))
    before = Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    blocks = salted.groupBy("cls", "salt").agg(F.count("*").alias("n"), F.sum("full").alias("f")).select(
        "cls", "salt",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_base"),
        F.coalesce(F.sum("f").over(before), F.lit(0)).alias("window_base"),
    )
    inside = Window.partitionBy("cls", "salt").orderBy(ROW_KEY).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        salted.withColumns({"ahead": F.count("*").over(inside), "windows": F.coalesce(F.sum("full").over(inside), F.lit(0))})
        .join(blocks, ["cls", "salt"])
        .select(
            ROW_KEY, "cls", "full",
            (F.col("ahead") + F.col("rank_base")).alias("rank"),
            (F.col("windows") + F.col("window_base") + F.col("full_base")).alias("first_window"),
        )
    )
    ranked = store(ranked, "pack-ranks")
    # The layout follows the number of lengths below the window, not the documents.
    laid = spark.createDataFrame(plan, "cls INT, lo LONG, hi LONG, begin LONG, length LONG, seq LONG, offset LONG")
    rest = ranked.join(F.broadcast(laid), "cls").where("rank >= lo AND rank < hi").select(
        ROW_KEY,
        (F.col("full") * window + F.col("begin")).alias("start"),
        "length",
        (F.col("seq") + F.col("rank") - F.col("lo")).alias("sequence_id"),
        "offset",
    )
    whole = ranked.where("full > 0").select(
        ROW_KEY, "first_window", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("i")
    ).select(
        ROW_KEY,
        (F.col("i") * window).alias("start"),
        F.lit(window).cast("long").alias("length"),
        (F.col("first_window") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    pieces = rest.unionByName(whole)
    return pieces.join(tokens, ROW_KEY).select(
        ROW_KEY, "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset",
        F.expr("substring(ids, CAST(start * 4 + 1 AS INT), CAST(length * 4 AS INT))").alias("ids"),
    )
