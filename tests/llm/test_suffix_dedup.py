"""Substring dedup over bytes against strings in a dictionary; transforms against sorted suffixes."""

import random

import numpy as np
import pytest
from cases import in_order

from stationlake.llm import spans
from stationlake.llm import suffix_dedup as D

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def plain(rows, window):
    seen, out = set(), []
    for _, r in in_order(rows):
        raw = (r[1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - window + 1):
            key = raw[s : s + window]
            if key in seen:
                gone[s : s + window] = True
            seen.add(key)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append(repr((r[0], len(raw), int(gone.sum()), runs, bytes(b for b, g in zip(raw, gone) if not g))))
    return sorted(out)


def check(frame, rows):
    got = D.remove_repeated_bytes(frame).collect()
    assert sorted(repr((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_text"]))) for r in got) == plain(rows, D.WINDOW)


def test_documents(docs, wide_docs, doc_rows):
    check(docs, doc_rows)
    check(wide_docs, doc_rows)


def pieces(seed, n=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        alphabet = "ab" if i % 2 else "abcdefghijklmnop "
        bases = ["".join(random.Random(b).choice(alphabet) for _ in range(400)) for b in range(3)]
        text = ""
        for _ in range(rng.randrange(4)):
            x, y = sorted(rng.randrange(401) for _ in range(2))
            text += rng.choice(bases)[x:y] + "".join(rng.choice(alphabet) for _ in range(rng.randrange(4)))
        rows.append((i, text, None, None, None))
    return rows


def test_overlaps_and_runs(spark):
    rows = pieces(1) + [(900, "z" * 1000, None, None, None), (901, "z" * 150, None, None, None)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


@pytest.mark.parametrize("seed", range(6))
def test_blocks_chunks_and_large_groups(monkeypatch, seed):
    """The steps in one process with small blocks, chunks and groups."""
    import pyarrow as pa

    rng = random.Random(seed)
    for module, name, value in ((D, "BLOCK_BYTES", rng.choice([150, 4000])), (spans, "CHUNK_ROWS", rng.choice([5, 100])),
                                (spans, "LARGE_GROUP", rng.choice([2, 4096])), (D, "MERGE_BYTES", rng.choice([50, 100_000]))):
        monkeypatch.setattr(module, name, value)
    rows = pieces(seed)
    texts = {i: t.encode() for i, t, *_ in rows}
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts.values()), pa.binary()), pa.array(list(texts))], ["text", "ord"])
    by = [("gram", "ascending"), ("ord", "ascending"), ("start", "ascending")]
    rows_ = pa.Table.from_batches(list(D._fragment_rows([batch]))).sort_by(by)
    verdicts = pa.Table.from_batches(list(spans.compare_fragments(rows_.to_batches(max_chunksize=37)))).to_pylist()
    found = [(v["ord"], v["start"], v["start"] + v["n"] + D.WINDOW - 1) for v in verdicts if v["gram"] is None]
    asked = [v for v in verdicts if v["gram"] is not None]
    kind = pa.list_(pa.struct([("gram", pa.int64()), ("large", pa.bool_()), ("start", pa.int64()), ("n", pa.int64())]))
    cut = pa.RecordBatch.from_arrays(
        [pa.array([texts[v["ord"]] for v in asked], pa.binary()), pa.array([v["ord"] for v in asked], pa.int64()), pa.array([[v] for v in asked], kind)],
        ["text", "ord", "parts"],
    )
    cut = pa.Table.from_batches(list(D._cut_rows([cut]))).sort_by([("key", "ascending"), ("ord", "ascending"), ("start", "ascending")])
    for b in D._merge(cut.to_batches(max_chunksize=11)):
        found += [(r["ord"], r["lo"], r["hi"]) for r in b.to_pylist()]
    got = {i: np.zeros(len(t), bool) for i, t in texts.items()}
    for i, x, y in found:
        got[i][x:y] = True
    seen = set()
    for i, raw in texts.items():
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - D.WINDOW + 1):
            if raw[s : s + D.WINDOW] in seen:
                gone[s : s + D.WINDOW] = True
            seen.add(raw[s : s + D.WINDOW])
        assert (got[i] == gone).all(), i


@pytest.mark.parametrize("copies", [1, 3])
def test_a_hot_gram_is_streamed(monkeypatch, copies):
    """Many different fragments of one gram: bounded work a chunk, each is settled by a copy or looked into."""
    import pyarrow as pa

    monkeypatch.setattr(spans, "CHUNK_ROWS", 100)
    monkeypatch.setattr(spans, "LARGE_GROUP", 20)
    sizes, real = [], spans.repeats
    monkeypatch.setattr(spans, "repeats", lambda keys, *rest: sizes.append(len(keys[0])) or real(keys, *rest))
    grams = [7] * 4000 + [8] * 2 + [9]
    digests = [i // copies if i % 2 else i % 10 for i in range(4000)] + [1, 1, 1]
    rows = pa.table({"gram": grams, "digest": digests, "ord": list(range(4003)), "start": [0] * 4003, "n": [5] * 4003})
    out = pa.Table.from_batches(list(spans.compare_fragments(rows.to_batches(max_chunksize=40)))).to_pylist()
    assert max(sizes) <= 100 + 40
    asked = {v["ord"] for v in out if v["gram"] is not None}
    settled = {v["ord"] for v in out if v["gram"] is None}
    assert len(out) == len(asked) + len(settled) and all(v["large"] for v in out if v["gram"] == 7)
    assert asked | settled == set(range(4000)) | {4001} and 4001 in settled
    first = {}
    for i, d in enumerate(digests[:4000]):  # who is first is looked into, who is settled has an earlier twin
        assert first.setdefault(d, i) != i or i in asked
    assert all(first[digests[i]] < i for i in settled if i < 4000) and len(settled) > 1500


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_merged_transforms_equal_one_sorted_collection(shards):
    rng = np.random.default_rng(shards)
    strings = [rng.integers(1, 4, rng.integers(0, 30)) for _ in range(12)]
    cuts = [len(strings) * i // shards for i in range(shards + 1)]
    transforms, suffixes = [], []
    for x, y in zip(cuts, cuts[1:]):
        text = np.concatenate([np.append(s, 0) for s in strings[x:y]])
        sa = D.sorted_suffixes(text)
        transforms.append(np.concatenate([[0], text[:-1]])[sa])
        suffixes.append([tuple(text[i : i + list(text[i:]).index(0)]) for i in sa])
        assert suffixes[-1] == sorted(suffixes[-1])
    for rounds in (1, 3, 100):
        z, parted = D.merge_transforms(transforms, rounds)
        turn = [iter(s) for s in suffixes]
        merged = [next(turn[i])[:rounds] for i in z.tolist()]
        assert merged == sorted(merged)
        # Ends of strings part too; among longer ones a new interval begins where the prefix changes.
        inner = [(a, b, bool(p)) for a, b, p in zip(merged, merged[1:], parted[1:]) if len(a) == len(b) == rounds]
        assert all(p == (a != b) for a, b, p in inner) and (rounds > 3 or inner)


def test_no_documents(no_docs):
    assert D.remove_repeated_bytes(no_docs).count() == 0
