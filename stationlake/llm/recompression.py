"""Substring dedup over words by recompression.

A first pass leaves out text that can't repeat: equal windows have the same
least half-window of words, so only windows whose least half-window is met
twice are candidates.  Maximal runs of candidates are zones; of zones with
equal words the earliest goes on.

Spark rounds then name what the zones are made of: the words, and level by
level the runs of one symbol and the pairs of neighbours (a pair is joined when
a bit of the level puts its left symbol on one side and its right symbol on the
other).  Tasks propose hashes as names; a round gathers the proposals of all
zones, level by level, in stored dictionaries, and where a name stands for
different contents all but one of these get a new name and the levels above are
proposed again from the names settled so far.
So a name stands for one sequence of words everywhere, and equal substrings
have equal symbols except near their ends.

A window's anchor is one of the symbols of the highest level that its own words
decide.  Equal windows have equal anchors, so anchors shared between zones
reveal the repeats, and the words of the windows verify them.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import store
from stationlake.llm.spans import ODD, in_order, mix, runs, span_digests
from stationlake.llm.suffix_dedup import sliding_min

WINDOW_WORDS = 20
#: Bytes of text that are named at once (at least one document or zone).
BLOCK_BYTES = 4 << 20
#: Windows of one anchor that a task remembers; further ones are dealt out by their own digests.
HELD_WINDOWS = 1 << 16
#: A proposed name: the highest bit (never set in a name given to a contested content), six bits of level, and a hash.
NAME_BITS = 57
WORD, RUN, PAIR = 0, 1, 2
ZONE = "ord LONG, start LONG, n LONG, words BINARY"
RENAMES = "ARRAY<STRUCT<content: BINARY, name: LONG>>"
_PLACE = np.uint64(32)  # bits for the place in a block
_CONTENT = np.dtype([("kind", "u1"), ("a", "<u8"), ("b", "<u8")])


def window_digests(sym: np.ndarray, window: int) -> np.ndarray:
    """Digest of every ``window`` consecutive symbols."""
    at = np.arange(max(0, len(sym) - window + 1))
    return span_digests(sym, at, at + window)


class Names:
    """Names of words, runs and pairs: proposed by hash unless the content was given another one."""

    def __init__(self, given: dict[bytes, int] | None = None, bits: int = NAME_BITS):
        self.given, self.bits = given or {}, bits

    def _proposed(self, level: int, digest: np.ndarray) -> np.ndarray:
        return (digest >> np.uint64(64 - self.bits)) | np.uint64(1 << 63 | min(level, 63) << 57)

    def words(self, words: list[bytes]) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        names = self._proposed(0, np.fromiter((digest(w) for w in words), np.uint64, len(words)))
        for i, w in enumerate(words) if self.given else ():
            if (name := self.given.get(bytes([WORD]) + w)) is not None:
                names[i] = name
        return names

    def joined(self, kind: int, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        names = self._proposed(level, mix(mix(a + np.uint64(kind)) * np.uint64(ODD) + b))
        for i, c in enumerate(contents(kind, a, b)) if self.given else ():
            if (name := self.given.get(c)) is not None:
                names[i] = name
        return names


def contents(kind: int, a: np.ndarray, b: np.ndarray) -> list[bytes]:
    """What a name stands for: the kind, and the symbol and length of a run or the symbols of a pair."""
    packed = np.empty(len(a), _CONTENT)
    packed["kind"], packed["a"], packed["b"] = kind, a, b
    data, size = packed.tobytes(), _CONTENT.itemsize
    return [data[i : i + size] for i in range(0, len(data), size)]


class Level:
    """Symbols after a round, the windows that still decide some of them (lo to hi), and what was named."""

    def __init__(self, sym, own, first, spans, live, lo, hi, made):
        self.sym, self.own, self.first, self.spans = sym, own, first, spans
        self.live, self.lo, self.hi, self.made = live, lo, hi, made

    def inside(self) -> np.ndarray:
        """Whether a symbol is decided by some window."""
        edge = np.bincount(self.lo, minlength=len(self.sym) + 1) - np.bincount(self.hi, minlength=len(self.sym) + 1)
        return np.cumsum(edge[: len(self.sym)]) > 0


def levels(sym: np.ndarray, own: np.ndarray, starts: np.ndarray, window: int, names: Names):
    """The levels, as long as a window decides a symbol.

    ``sym``: names of all words; ``own``: the text of each; ``starts``: first words of the windows.
    """
    first, spans = np.arange(len(sym)), np.ones(len(sym), np.int64)
    live, lo, hi = np.arange(len(starts)), starts, starts + window
    for level in itertools.count(1):
        # Runs.
        new = np.ones(len(sym), bool)
        new[1:] = (sym[1:] != sym[:-1]) | (own[1:] != own[:-1])
        run, heads = np.cumsum(new) - 1, np.flatnonzero(new)
        lo, hi = run[lo] + 1, run[hi - 1]
        keep = lo < hi
        live, lo, hi = live[keep], lo[keep], hi[keep]
        if not len(live):
            return
        size = np.diff(np.append(heads, len(sym)))
        spans, sym, own, first = np.add.reduceat(spans, heads), sym[heads], own[heads], first[heads]
        many = np.flatnonzero(size > 1)
        made_runs = sym[many], size[many].astype(np.uint64)
        sym[many] = names.joined(RUN, level, *made_runs)
        # Pairs: left symbols of one side with right symbols of the other.
        right = (mix(sym ^ np.uint64(level * 0x1F123BB5)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(len(sym), bool)
        joins[:-1] = ~right[:-1] & right[1:] & (own[:-1] == own[1:])
        begin = np.ones(len(sym), bool)
        begin[1:] = ~joins[:-1]
        at, heads = np.cumsum(begin) - 1, np.flatnonzero(begin)
        lo, hi = lo + right[lo], hi - ~right[hi - 1]
        keep = lo < hi
        live, lo, hi = live[keep], lo[keep], hi[keep]
        if not len(live):
            return
        lo, hi = at[lo], at[hi - 1] + 1
        pair = np.flatnonzero(joins)
        made_pairs = sym[pair], sym[pair + 1]
        spans, sym, own, first = np.add.reduceat(spans, heads), sym[heads], own[heads], first[heads]
        sym[at[pair]] = names.joined(PAIR, level, *made_pairs)
        here = Level(sym, own, first, spans, live, lo, hi, [])
        inside, run_at = here.inside(), at[many]
        for kind, place, (a, b) in ((RUN, run_at, made_runs), (PAIR, at[pair], made_pairs)):
            asked = inside[place]
            here.made.append((kind, a[asked], b[asked]))
        yield here


def anchors(sym: np.ndarray, own: np.ndarray, starts: np.ndarray, window: int, names: Names):
    """(name, place, level) of the anchor of each window: of its highest level's symbols the longest, then the least by hash.

    ``place`` tells apart the occurrences of a name.  A window that decides no
    symbol (a run goes through it) has its own digest as name, level 0.
    """
    name, place, top = window_digests(sym, window)[starts], starts.copy(), np.zeros(len(starts), np.int64)
    before = None

    def settle(a: Level, level: int, gone: np.ndarray) -> None:
        order = mix(a.sym + np.uint64(level)) >> np.uint64(8)
        order |= (np.uint64(255) - np.minimum(a.spans, 255).astype(np.uint64)) << np.uint64(56)
        idx, end, who = a.lo[gone], a.hi[gone], a.live[gone]
        best = idx.copy()
        for _ in range(int((end - idx).max()) - 1 if len(idx) else 0):
            idx = np.minimum(idx + 1, end - 1)
            best = np.where(order[idx] < order[best], idx, best)
        name[who], place[who], top[who] = mix(a.sym[best] + np.uint64(level << 1)), a.first[best] * (window + 1) + level, level

    for level, now in enumerate(levels(sym, own, starts, window, names), 1):
        if before is not None:
            alive = np.zeros(len(starts), bool)
            alive[now.live] = True
            settle(before, level - 1, ~alive[before.live])
        before, last = now, level
    if before is not None:
        settle(before, last, np.ones(len(before.live), bool))
    return name, place, top


def _blocks(rows, size):
    """Lists of rows whose ``size`` adds up to BLOCK_BYTES."""
    part, held = [], 0
    for r in rows:
        part.append(r)
        held += size(r)
        if held >= BLOCK_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def _laid_out(texts: list[list[bytes]], window: int):
    """(words, text of each, place in its text, places where a window starts) of all texts."""
    sizes = np.array([len(w) for w in texts], np.int64)
    own = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return [w for t in texts for w in t], own, inside, np.flatnonzero(inside + window <= sizes[own])


def _stretches(ords: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows in the order of their texts, those that follow one another as one."""
    follow = np.zeros(len(ords), bool)
    follow[1:] = (ords[1:] == ords[:-1]) & (start[1:] == start[:-1] + n[:-1])
    first, _ = runs(follow)
    size = np.add.reduceat(n, first) if len(first) else n
    return ords[first], start[first], size


def _half_rows(window: int):
    """Runs of windows with one least half-window, the first of a block; ``other``: stretches of windows met twice in it."""
    half = max(1, window // 2)

    def run(batches):
        for b in batches:
            rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            for block in _blocks(rows, lambda r: len(r[0] or b"")):
                words, own, inside, at = _laid_out([(t or b"").split() for t, _ in block], window)
                if not len(at):
                    continue
                digests = window_digests(Names().words(words), half)
                spot = np.arange(len(digests), dtype=np.uint64)
                least = sliding_min((digests >> _PLACE << _PLACE) | spot, window - half + 1)
                place = (least[at] & np.uint64((1 << 32) - 1)).astype(np.int64)
                follow = np.zeros(len(at), bool)
                follow[1:] = (place[1:] == place[:-1]) & (at[1:] == at[:-1] + 1)
                first, n = runs(follow)
                key = digests[place[first]].view(np.int64)
                ords, start = np.array([o for _, o in block], np.int64)[own[at[first]]], inside[at[first]]
                _, met, which, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                sure = times[which] > 1
                # One row of each half-window speaks for the block; windows that are sure come as whole stretches.
                o, x, size = _stretches(ords[sure], start[sure], n[sure])
                sure = sure[met]
                cols = (key[met], np.zeros(len(met), bool), sure, ords[met], start[met], n[met])
                more = (o, np.ones(len(o), bool), np.ones(len(o), bool), o, x, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(cols, more)], ["key", "other", "sure", "ord", "start", "n"]
                )

    return run


def _shared(batches):
    """Rows sorted by (other, key): stretches, and runs of windows whose half-window another block has too."""
    held, waits, last = None, False, False
    for b in batches:
        if not b.num_rows:
            continue
        rows = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:  # the last row so far, whose key may go on
            rows = [np.concatenate(x) for x in zip(held, rows)]
        key, other, sure, met = rows[0], rows[1], rows[2], np.zeros(len(rows[0]), bool)
        same = (key[1:] == key[:-1]) & (other[1:] == other[:-1])
        met[1:] |= same
        met[:-1] |= same
        met[0] |= waits
        keep = other | (met & ~sure)  # what is sure is in a stretch
        held, waits = [x[-1:].copy() for x in rows], met[-1]
        last, keep[-1] = keep[-1], False
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in rows[3:]], ["ord", "start", "n"])
    if held is not None and last:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[3:]], ["ord", "start", "n"])


def _zone_rows(window: int):
    """Maximal runs of candidates with their words; without words where a batch has had the same words already."""

    def run(batches):
        for b in batches:
            found, out, met = [], [], set()
            for raw, o, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                words, zones = raw.split(), []
                for start, n in sorted((p["start"], p["n"]) for p in parts):
                    if zones and zones[-1][1] == start:
                        zones[-1][1] = start + n
                    else:
                        zones.append([start, start + n])
                for x, y in zones:
                    found.append((o, x, y - x, b" ".join(words[x : y + window - 1])))
            for o, x, n, content in sorted(found):
                out.append((o, x, n, None if content in met else content))
                met.add(content)
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["ord", "start", "n", "words"])

    return run


def _earliest(batches):
    """Rows sorted by (words, ord, start): only the first of equal words keeps them."""
    last = None
    for b in batches:
        kept = []
        for w in b.column(3).to_pylist():
            kept.append(None if w == last else w)
            last = w
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(kept, pa.binary())], ["ord", "start", "n", "words"])


def _named_blocks(batches, window: int, bits: int):
    """(zones, words, names of words, zone of each, place in it, starts of windows, naming) of blocks of zones."""
    for b in batches:
        rows = zip(*(b.column(c).to_pylist() for c in ("ord", "start", "words", "renames")))
        for block in _blocks(rows, lambda r: len(r[2])):
            names = Names({x["content"]: x["name"] for r in block for x in r[3] or ()}, bits)
            words, own, inside, at = _laid_out([r[2].split(b" ") for r in block], window)
            yield block, words, names.words(words), own, inside, at, names


def _made(words, sym, own, at, window, names, since=0):
    """(level, names, contents) of what is named at each level from ``since`` on (0: the words)."""
    if since == 0:
        different = list(dict.fromkeys(words))
        yield 0, names.words(different), [bytes([WORD]) + w for w in different]
    for level, here in enumerate(levels(sym, own, at, window, names), 1):
        if level < since:
            continue
        yield level, np.zeros(1, np.uint64), [b""]  # some window goes on, whether or not anything is named
        for kind, a, b in here.made:
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            yield level, names.joined(kind, level, a[new], b[new]), contents(kind, a[new], b[new])


def _proposals(window: int, level: int, bits: int, above: bool = False):
    """What is named at ``level``; with ``above`` also at every later level, as if no name of this round were contested."""

    def run(batches):
        for block, words, sym, own, _, at, names in _named_blocks(batches, window, bits):
            for here, name, content in _made(words, sym, own, at, window, names, level):
                if here > level and not above:
                    break
                cols = [pa.array(np.full(len(content), here, np.int32)), pa.array(name.view(np.int64)), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["level", "name", "content"])

    return run


def _users(window: int, level: int, bits: int):
    """The zones in which a content occurs, one zone at a time."""

    def run(batches):
        for b in batches:
            for one in (b.slice(i, 1) for i in range(b.num_rows)):
                for block, words, sym, own, _, at, names in _named_blocks([one], window, bits):
                    named = itertools.takewhile(lambda x: x[0] == level, _made(words, sym, own, at, window, names, level))
                    made = sorted({c for _, _, content in named for c in content})
                    o, s = (pa.array([block[0][i]] * len(made), pa.int64()) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays([o, s, pa.array(made, pa.binary())], ["ord", "start", "content"])

    return run


def name_zones(zones: DataFrame, window: int = WINDOW_WORDS, bits: int = NAME_BITS) -> tuple[DataFrame, list[DataFrame]]:
    """(``zones`` with ``renames``, the dictionary of each level).

    A dictionary has ``name, content, rank``; contents of rank 2 and above
    share a proposed name and get one of their own, which is carried to the
    zones that they occur in.  A Spark round gathers the proposals of all levels
    not settled yet.  It settles the levels up to the first that has a contested
    name, and what it gathered above is proposed again in the next round, from
    the names that are settled then.
    """
    zones = zones.withColumn("renames", F.lit(None).cast(RENAMES))
    dictionaries = []
    while True:
        since = len(dictionaries)
        made = zones.mapInArrow(_proposals(window, since, bits, above=True), "level INT, name LONG, content BINARY")
        made = made.repartition("name").dropDuplicates(["level", "name", "content"])
        rank = F.row_number().over(Window.partitionBy("name", "level").orderBy("content"))
        gathered = store(made.withColumn("rank", rank), f"names-{since}")
        contested_at, top = gathered.agg(F.min(F.when(F.col("rank") > 1, F.col("level"))), F.max("level")).first()
        if top is None:
            return zones, dictionaries
        settled = top if contested_at is None else contested_at
        dictionaries += [gathered.where(F.col("level") == x).drop("level") for x in range(since, settled + 1)]
        if contested_at is None:
            return zones, dictionaries
        fresh = F.monotonically_increasing_id() + F.lit(settled << 55)
        contested = dictionaries[settled].where("rank > 1").orderBy("name", "content")
        fresh = store(contested.select("content", fresh.alias("name")), f"renames-{settled}")
        users = zones.mapInArrow(_users(window, settled, bits), "ord LONG, start LONG, content BINARY")
        more = users.join(fresh, "content").groupBy("ord", "start").agg(F.collect_list(F.struct("content", "name")).alias("more"))
        zones = zones.join(more, ["ord", "start"], "left")
        renames = F.coalesce(F.concat("renames", "more"), "renames", "more")
        zones = store(zones.withColumn("renames", renames).drop("more"), f"zones-{settled}")


def _anchored(window: int, bits: int):
    """Runs of windows with one anchor and their words; without words stretches of runs that the block has had before."""

    def run(batches):
        for block, words, sym, own, inside, at, names in _named_blocks(batches, window, bits):
            name, place, top = anchors(sym, own, at, window, names)
            follow = np.zeros(len(at), bool)
            follow[1:] = (place[1:] == place[:-1]) & (name[1:] == name[:-1]) & (at[1:] == at[:-1] + 1)
            first, n = runs(follow)
            x = at[first]
            content = [b" ".join(words[i:j]) for i, j in zip(x.tolist(), (x + n + window - 1).tolist())]
            ords, begins = (np.array([r[i] for r in block], np.int64) for i in (0, 1))
            ords, starts, key = ords[own[x]], begins[own[x]] + inside[x], name[first].view(np.int64)
            order = np.lexsort((starts, ords))
            met, old = set(), np.zeros(len(x), bool)
            for i in order.tolist():
                old[i] = content[i] in met
                met.add(content[i])
            gone = order[old[order]]
            o, s, size = _stretches(ords[gone], starts[gone], n[gone])
            new = np.flatnonzero(~old)
            cols = [
                *(pa.array(np.concatenate(c)) for c in ((key[new], o), (ords[new], o), (starts[new], s), (n[new], size))),
                pa.array([content[i] for i in new.tolist()] + [None] * len(o), pa.binary()),
                pa.array(np.concatenate([top[first[new]], np.zeros(len(o), np.int64)])),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["key", "ord", "start", "n", "words", "level"])

    return run


def _verify(window: int, most: int | None):
    """Rows sorted by (key, ord, start): runs of windows whose words came earlier under the key (words null).

    Of a key ``most`` different windows are remembered.  A window first met
    later, and every copy of it, is given out under its own digest.
    """

    def run(batches):
        last, seen, whole = None, set(), set()
        for b in batches:
            keys, ords, starts, sizes, texts = (b.column(c).to_pylist() for c in ("key", "ord", "start", "n", "words"))
            out = []
            for key, o, start, n, raw in zip(keys, ords, starts, sizes, texts):
                if raw is None:
                    out.append((None, o, start, n, None))
                    continue
                if key != last:
                    last, seen, whole = key, set(), set()
                if raw in whole:
                    out.append((None, o, start, n, None))
                    continue
                if n > 1:
                    if most is None or len(whole) < most:
                        whole.add(raw)
                    cuts = list(itertools.accumulate(map(len, raw.split(b" ")), lambda x, y: x + y + 1, initial=0))
                    windows = [raw[x : y - 1] for x, y in zip(cuts, cuts[window:])]
                else:
                    windows = [raw]
                began = None
                for j, w in enumerate(windows):
                    if w in seen:
                        began = j if began is None else began
                        continue
                    if began is not None:
                        out.append((None, o, start + began, j - began, None))
                        began = None
                    if most is None or len(seen) < most:
                        seen.add(w)
                    else:
                        out.append((xxhash.xxh64_intdigest(w) - (1 << 63), o, start + j, 1, w))
                if began is not None:
                    out.append((None, o, start + began, n - began, None))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["key", "ord", "start", "n", "words"])

    return run


def repeated_zones(ordered: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """ZONE rows, stored: zones with words are the earliest with these; the others (words null) repeat one whole."""
    halves = ordered.select("text", "ord").mapInArrow(
        _half_rows(window), "key LONG, other BOOLEAN, sure BOOLEAN, ord LONG, start LONG, n LONG"
    )
    shared = halves.repartition("key").sortWithinPartitions("other", "key").mapInArrow(_shared, "ord LONG, start LONG, n LONG")
    parts = shared.groupBy("ord").agg(F.collect_list(F.struct("start", "n")).alias("parts"))
    # The same columns as in the last join of the texts, so that they are shuffled once for both.
    cut = ordered.join(parts.hint("merge"), "ord").select("text", "ord", "parts", "doc_id")
    cut = cut.mapInArrow(_zone_rows(window), ZONE)
    deal = F.when(F.col("words").isNull(), F.col("ord")).otherwise(F.xxhash64("words"))
    dealt = cut.repartition(deal).sortWithinPartitions("words", "ord", "start")
    return store(dealt.mapInArrow(_earliest, ZONE), "zones")


def covered_spans(
    ordered: DataFrame, window: int = WINDOW_WORDS, bits: int = NAME_BITS, held: int = HELD_WINDOWS
) -> DataFrame:
    """``ord, lo, hi``: words lo to hi (exclusive) of a document covered by windows with an earlier twin."""
    zones = repeated_zones(ordered, window)
    named, _ = name_zones(zones.where("words IS NOT NULL"), window, bits)
    rows = named.mapInArrow(_anchored(window, bits), "key LONG, ord LONG, start LONG, n LONG, words BINARY, level LONG").drop("level")

    def verified(rows, most):
        dealt = rows.repartition("key").sortWithinPartitions("key", "ord", "start")
        return dealt.mapInArrow(_verify(window, most), f"key LONG, {ZONE}")

    judged = store(verified(rows, held), "anchors")
    found = zones.where("words IS NULL").unionByName(judged.where("words IS NULL").drop("key"))
    found = found.unionByName(verified(judged.where("words IS NOT NULL"), None).drop("key"))
    return found.select("ord", F.col("start").alias("lo"), (F.col("start") + F.col("n") + window - 1).alias("hi"))


def _apply(batches):
    for b in batches:
        n_words, n_removed, texts = [], [], []
        for raw, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            words = (raw or b"").split()
            n_words.append(len(words))
            if spans:
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    gone[s["lo"]] += 1
                    gone[s["hi"]] -= 1
                keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                n_removed.append(len(words) - len(keep))
                words = [words[i] for i in keep]
            else:
                n_removed.append(0)
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary())],
            ["ord", "doc_id", "n_words", "n_removed", "kept_text"],
        )


def remove_repeated_words(
    docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``ord, doc_id, n_words, n_removed, kept_text`` (UTF-8 bytes).

    A word (of ``[^\\x20\\x09-\\x0D]+``) is removed when a window of ``window``
    consecutive words covers it whose word sequence also starts earlier: in a
    document with a smaller doc_id, or earlier in the same one; windows may
    overlap and are judged on the input.  The kept words are joined by one
    space.  A null text has no words; documents shorter than a window lose
    nothing.  Rows with a null doc_id come last, repeated doc_ids in the order
    of their rows.  An empty table gives no rows; other columns are not used.

    Whole texts are read, and words decide: names and digests only bring equal
    windows together.  Equal zones and equal runs of windows inside a block are
    settled before the shuffle, so a passage that a third of the documents hold
    sends one row per block.  A task remembers HELD_WINDOWS windows of an
    anchor; what is first met later is dealt out by the digests of its words.
    """
    ordered = in_order(docs, id_col, text_col)
    spans = covered_spans(ordered, window).groupBy("ord").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    whole = ordered.join(spans.hint("merge"), "ord", "left").select("ord", "doc_id", "text", "spans")
    return whole.mapInArrow(_apply, "ord LONG, doc_id LONG, n_words LONG, n_removed LONG, kept_text BINARY")
