"""Prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from stationlake.llm import prefix_trie as T
from stationlake.llm import queries as Q

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    members, ends = {}, {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, convs in members.items():
        below = [k for k in members if k[: len(node)] == node]
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(k not in children for k in below)
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves, saved, digest))
    return sorted(map(repr, out))


def check(spark, monkeypatch, rows, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(Q, "read_table", lambda *_: frame)
    got = Q.op11_prefix_trie(spark, "").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute([r[:4] for r in rows])


def conversations(seed, n, longest=9, step=1):
    rng = random.Random(seed)
    rows = []
    for c in range(0, n * step, step):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(("user", "assistant", None)), rng.choice(("a", "bb", "ccc é漢", "", None))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,salts", [(4_096, 64), (2, 3)])
def test_shared_beginnings(spark, monkeypatch, block, salts):
    monkeypatch.setattr(T, "BLOCK", block)
    monkeypatch.setattr(T, "SALTS", salts)
    check(spark, monkeypatch, conversations(1, 130))


def test_absent_bases_and_turnless_conversations(spark, monkeypatch):
    rows = conversations(2, 40, 5, 7) + [(1001, 0, "user", "x"), (1002, 0, "user", "x"), (-105, 1, "user", "x"), (-100, 0, "user", "y")]
    found = rebuilt(rows)
    assert any(not turns for turns in found.values())
    check(spark, monkeypatch, rows)


def test_copies_ties_nulls_and_clashing_names(spark, monkeypatch):
    rows = [(c, t, "user", "same") for c in range(60) for t in range(3)]  # one sequence, many conversations
    rows += [(200, None, "user", "null first"), (200, 0, "user", "a"), (200, 0, "user", "a"), (None, 0, "user", "lost"), (None, None, None, None)]
    rows = [(*r, "x", "y", "z") for r in rows]
    check(spark, monkeypatch, rows, SCHEMA + ", node STRING, pos STRING, row_key STRING")


def test_a_very_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 16)
    long = [(300, t, "user", f"t{t % 3}") for t in range(200)]
    also = [(301, t, "user", f"t{t % 3}") for t in range(150)]
    check(spark, monkeypatch, long + also + conversations(3, 10))


def test_no_conversations(spark):
    trie = T.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert trie.nodes.count() == 0 and T.end_digests(trie.ends).count() == 0


def test_last_turns_are_read_back(spark):
    rows = conversations(4, 50)
    frame = spark.createDataFrame(rows, SCHEMA)
    path = T.store(frame, "conversations")
    numbered = T.number_turns(path)
    convs, turns = T.rebuild(numbered)
    trie = T.build(convs, turns)
    found = rebuilt(rows)
    got = T.with_last_turn(trie.nodes, turns, path).collect()
    assert len(got) == trie.nodes.count() - 1
    for r in got:
        assert found[r["conv_id"]][r["depth"] - 1] == (r["role"] or "", r["text"] or "")
