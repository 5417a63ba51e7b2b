"""Substring dedup over words against windows in a dictionary."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from cases import in_order, words

from stationlake.llm import recompression as R

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def plain(rows, window):
    seen, out = set(), []
    for _, r in in_order(rows):
        text = (r[1] or "").encode().split()
        gone = [False] * len(text)
        for s in range(len(text) - window + 1):
            key = tuple(text[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(text, gone) if not g)
        out.append(repr((r[0], len(text), sum(gone), kept)))
    return sorted(out)


def check(frame, rows, window=20):
    got = R.remove_repeated_words(frame, window).collect()
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept_text"]))) for r in got) == plain(rows, window)


def test_documents(docs, wide_docs, doc_rows):
    check(docs, doc_rows)
    check(wide_docs, doc_rows)


def covered(rows, window):
    """Per document, whether a word is covered by a window with an earlier twin."""
    seen, out = set(), {}
    for i, t, *_ in rows:
        w = t.split()
        out[i] = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                out[i][s : s + window] = [True] * window
            seen.add(key)
    return out


def table(batches, order=()):
    made = pa.Table.from_batches(list(batches))
    return made.sort_by([(c, "ascending") for c in order]) if order else made


def mine(rows, window, bits, held, size):
    """The steps in one process, sorted rows in batches of ``size``."""
    texts = {i: t.encode() for i, t, *_ in rows}
    got = {i: [False] * len(t.split()) for i, t in texts.items()}
    docs = pa.table({"text": pa.array(list(texts.values()), pa.binary()), "ord": list(texts)})
    halves = list(R._half_rows(window)(docs.to_batches(max_chunksize=size)))
    if not halves:
        return got
    parts = {}
    for r in table(R._shared(table(halves, ["other", "key"]).to_batches(max_chunksize=size))).to_pylist():
        parts.setdefault(r["ord"], []).append({"start": r["start"], "n": r["n"]})
    kind = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))
    cut = pa.table([pa.array([texts[o] for o in parts], pa.binary()), pa.array(list(parts), pa.int64()), pa.array(list(parts.values()), kind)], ["text", "ord", "parts"])
    zones = table(R._zone_rows(window)(cut.combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], cut.schema)]), ["words", "ord", "start"])
    zones = table(R._earliest(zones.to_batches(max_chunksize=size) or [pa.RecordBatch.from_pylist([], zones.schema)]))
    found = [z for z in zones.to_pylist() if z["words"] is None]
    kept = [z for z in zones.to_pylist() if z["words"] is not None]
    given = {}
    kind = pa.list_(pa.struct([("content", pa.binary()), ("name", pa.int64())]))

    def batches():
        renames = pa.array([[{"content": c, "name": n} for c, n in given.items()]] * len(kept), kind)
        cols = [pa.array([z[c] for z in kept], k) for c, k in (("ord", pa.int64()), ("start", pa.int64()), ("words", pa.binary()))]
        return pa.table([*cols, renames], ["ord", "start", "words", "renames"]).to_batches(max_chunksize=size)

    for level in range(30) if kept else ():
        made = {(r["name"], r["content"]) for b in R._proposals(window, level, bits)(batches()) for r in b.to_pylist()}
        if not made:
            break
        met = set()
        for name, content in sorted(made):
            if name in met:
                given[content] = len(given)
            met.add(name)
    if kept:
        rows = table(R._anchored(window, bits)(batches()), ["key", "ord", "start"])
        judged = table(R._verify(window, held)(rows.to_batches(max_chunksize=size)), ["key", "ord", "start"])
        found += [r for r in judged.to_pylist() if r["words"] is None]
        over = judged.filter(pa.compute.is_valid(judged["words"]))
        found += [r for b in R._verify(window, None)(over.to_batches(max_chunksize=size)) for r in b.to_pylist()]
    for r in found:
        got[r["ord"]][r["start"] : r["start"] + r["n"] + window - 1] = [True] * (r["n"] + window - 1)
    return got


@pytest.mark.parametrize("seed", range(40))
def test_blocks_batches_contested_names_and_large_groups(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(R, "BLOCK_BYTES", rng.choice([1, 200, 5000]))
    rows, window = few_words(seed), rng.choice([3, 6, 20])
    got = mine(rows, window, rng.choice([2, 5, R.NAME_BITS]), rng.choice([1, 4, 1 << 16]), rng.choice([1, 7, 1000]))
    assert got == covered(rows, window)


def few_words(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(40):
        alphabet = "ab" if i % 2 else "abcdefghij"
        bases = [[random.Random(b).choice(alphabet) for _ in range(60)] for b in range(3)]
        text = []
        for _ in range(rng.randrange(4)):
            x, y = sorted(rng.randrange(61) for _ in range(2))
            text += rng.choice(bases)[x:y] + [rng.choice(alphabet) for _ in range(rng.randrange(4))]
        rows.append((i, " ".join(text), None, None, None))
    return rows


@pytest.mark.parametrize("seed,bits,held", [(1, R.NAME_BITS, R.HELD_WINDOWS), (2, 5, 3)])
def test_pieces_of_few_words(spark, seed, bits, held):
    """Runs, periods and overlaps; also with names that many contents share, and few windows held."""
    rows = few_words(seed)
    ordered = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id AS ord", "doc_id", "CAST(text AS BINARY) AS text")
    got = {i: [False] * len(t.split()) for i, t, *_ in rows}
    for r in R.covered_spans(ordered, 6, bits, held).collect():
        got[r["ord"]][r["lo"] : r["hi"]] = [True] * (r["hi"] - r["lo"])
    assert got == covered(rows, 6)


def test_names_of_all_levels_stand_for_one_content(spark):
    """Rounds go on while a window decides a symbol; contents that share a proposed name are given different ones."""
    texts = [" ".join(words(seed, 90)) + " " + " ".join(words(1, 70)) for seed in (2, 3)]
    ordered = spark.createDataFrame([(i, i, t.encode()) for i, t in enumerate(texts)], "ord LONG, doc_id LONG, text BINARY")
    zones = R.repeated_zones(ordered)
    for bits in (4, R.NAME_BITS):
        named, dictionaries = R.name_zones(zones.where("words IS NOT NULL"), bits=bits)
        made = [r for d in dictionaries for r in d.where("name != 0").collect()]
        given = {x["content"]: x["name"] for z in named.collect() for x in z["renames"] or ()}
        assert bool(given) == (bits == 4)
        names = [given.get(bytes(r["content"]), r["name"]) for r in made]
        assert len(set(names)) == len({bytes(r["content"]) for r in made}) == len(made)
        assert len(dictionaries) > 3 and all(d.where("name != 0").count() for d in dictionaries[:4])


def test_levels_without_contested_names_take_one_round(spark, monkeypatch):
    """A round gathers every level; it is repeated only above a level with contested names, until all are settled."""
    texts = [" ".join(words(seed, 90)) + " " + " ".join(words(1, 70)) for seed in (2, 3)]
    ordered = spark.createDataFrame([(i, i, t.encode()) for i, t in enumerate(texts)], "ord LONG, doc_id LONG, text BINARY")
    zones, stored, found = R.repeated_zones(ordered).where("words IS NOT NULL"), R.store, {}
    for bits in (4, R.NAME_BITS):
        names = []
        monkeypatch.setattr(R, "store", lambda df, name: names.append(name) or stored(df, name))
        _, dictionaries = R.name_zones(zones, bits=bits)
        found[bits] = [sum(n.startswith("names-") for n in names), len(dictionaries)]
        contested = [d.where("rank > 1").count() > 0 for d in dictionaries]
        assert sum(contested) == sum(n.startswith("renames-") for n in names)
    assert found[R.NAME_BITS][0] == 1 and found[4][0] > 1
    assert found[4][1] > 3 and found[R.NAME_BITS][1] > 3


def test_long_repeats_are_revealed_by_high_levels():
    """Two texts share 70 words: every shared window has the same anchor in both, most at level 3 or above."""
    texts = [" ".join(words(seed, 90) + words(1, 70)).encode() for seed in (2, 3)]
    zones = pa.table([pa.array([0, 1]), pa.array([0, 0]), pa.array(texts, pa.binary()), pa.nulls(2, pa.list_(pa.struct([("content", pa.binary()), ("name", pa.int64())])))],
                     ["ord", "start", "words", "renames"])
    rows = table(R._anchored(20, R.NAME_BITS)(zones.to_batches(max_chunksize=1))).to_pylist()
    at = [{r["start"] + j: (r["key"], r["level"]) for r in rows if r["ord"] == o for j in range(r["n"])} for o in (0, 1)]
    shared = range(90, 90 + 70 - 19)
    assert all(at[0][s] == at[1][s] for s in shared)
    assert sum(at[0][s][1] >= 3 for s in shared) > 0.8 * len(shared)


def test_anchors_follow_the_window_alone():
    """Equal windows have equal anchor names whatever surrounds them."""
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 50, 80).astype(np.uint64)
    names = []
    for n in (0, 1, 5, 33):
        sym = np.concatenate([rng.integers(0, 50, n).astype(np.uint64), shared, rng.integers(0, 50, 9).astype(np.uint64)])
        starts = np.arange(n, n + 61)
        names.append(R.anchors(R.mix(sym), np.zeros(len(sym), int), starts, 20, R.Names())[0])
    assert all((x == names[0]).all() for x in names)
    assert len(set(names[0].tolist())) < 40  # neighbouring windows share anchors


def test_no_documents(no_docs):
    assert R.remove_repeated_words(no_docs).count() == 0
