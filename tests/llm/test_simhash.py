"""SimHash near-dedup against a plain fingerprint and all-pairs reachability."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import simhash as S


def plain(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ABab \n\t\x0b\u00a0\u0130é", max_size=60))
def test_fingerprint(text):
    assert S.fingerprint(text.encode(), 3) == plain(text)


def test_fingerprint_of_a_text_longer_than_a_block(monkeypatch):
    text = " ".join(str(i % 97) for i in range(500))
    monkeypatch.setattr(S, "BLOCK", 64)
    assert S.fingerprint(text.encode(), 3) == plain(text)


def groups(values, bits):
    left, out = set(values), {}
    while left:
        root = min(left)
        front, seen = {root}, {root}
        left.discard(root)
        while front:
            near = {v for v in left if any((v ^ f).bit_count() <= bits for f in front)}
            left -= near
            seen |= near
            front = near
        out |= dict.fromkeys(seen, root)
    return out


@pytest.mark.parametrize("bits,large", [(0, 1024), (1, 1024), (2, 1024), (2, 2), (3, 1024), (3, 3), (6, 4)])
def test_links_keep_every_connection(spark, monkeypatch, bits, large):
    monkeypatch.setattr(S, "LARGE_BUCKET", large)
    rng = random.Random(bits * 10 + large)
    values = set()
    for _ in range(12):  # clusters around centres, so that chains and large buckets occur
        centre = rng.getrandbits(64)
        for _ in range(25):
            v = centre
            for _ in range(rng.randrange(2 * bits + 2)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [(int(np.array([v], np.uint64).view(np.int64)[0]),) for v in values]
    links = S.links_within(spark.createDataFrame(signed, "fp BIGINT"), bits).collect()
    unsigned = lambda x: x & (1 << 64) - 1
    got = {unsigned(r["node"]): r["root"] for r in S.connected_components(S.links_within(spark.createDataFrame(signed, "fp BIGINT"), bits)).collect()}
    want = groups(values, bits)
    assert all(want[unsigned(r["a"])] == want[unsigned(r["b"])] for r in links)  # a star for each part of a bucket
    linked = {v for v in values if sum(want[v] == want[w] for w in values) > 1}
    assert set(got) == linked
    assert len({(want[v], got[v]) for v in linked}) == len({want[v] for v in linked}) == len({got[v] for v in linked})


def test_documents(spark, docs, wide_docs, doc_rows):
    want = groups({plain(r[1]) for r in doc_rows}, 2)
    ids = {}
    for r in doc_rows:
        if r[0] is not None:
            root = want[plain(r[1])]
            ids[root] = min(ids.get(root, r[0]), r[0])
    expected = sorted(repr((r[0], f"{plain(r[1]):016x}", ids.get(want[plain(r[1])]))) for r in doc_rows)
    for frame in (docs, wide_docs):
        rows = S.near_duplicates(frame, 3, 2).collect()
        assert sorted(repr((r["doc_id"], r["fingerprint"], r["component_id"])) for r in rows) == expected
        stay = [r for r in rows if r["stays"]]
        assert len(stay) == len(set(want.values())) and all(r["doc_id"] == r["component_id"] for r in stay)


def test_no_documents(no_docs):
    assert S.near_duplicates(no_docs).count() == 0
