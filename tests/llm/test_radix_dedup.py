"""Exact dedup by radix partitioning against a dictionary of normal forms."""

import hashlib
import random

import pytest

from stationlake.llm import radix_dedup as R


def plain(rows):
    normal = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    by = {}
    for r in rows:
        by.setdefault(normal(r[1]), []).append(r)
    out = []
    for r in rows:
        group = by[normal(r[1])]
        first = min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
        out.append((r[0], first[0], len(group), hashlib.sha256(normal(r[1]).encode()).hexdigest()))
    return sorted(map(repr, out)), len(by)


def check(frame, rows):
    got = R.exact_duplicates(frame).collect()
    want, groups = plain(rows)
    assert sorted(repr((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == groups and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_documents(docs, wide_docs, doc_rows):
    check(docs, doc_rows)
    check(wide_docs, doc_rows)


@pytest.mark.parametrize("first,growth", [(1, 2), (2, 3), (5, 16)])
def test_every_digit_boundary(spark, monkeypatch, first, growth):
    """Texts that part, end and agree at every length around the digits."""
    monkeypatch.setattr(R, "FIRST_DIGIT", first)
    monkeypatch.setattr(R, "GROWTH", growth)
    rng = random.Random(first)
    texts = ["a" * n for n in range(0, 20)] * 2 + ["a" * n + "b" for n in range(12)] + ["".join(rng.choice("a b") for _ in range(rng.randrange(14))) for _ in range(60)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    check(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"), rows)


def test_no_documents(no_docs):
    assert R.exact_duplicates(no_docs).count() == 0
