"""Packing: an exact round trip of ids, full windows, and the solver on known histograms."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import words
from tokenizers import Tokenizer

from stationlake.llm import packing as P

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(frame, rows, tokenizer, window=2048):
    """Every id of every row once, gapless sequences of at most a window; returns the padding."""
    pieces = P.pack(frame, window=window).collect()
    by, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[tuple(p["row_key"])].append(p)
        sequences[p["sequence_id"]].append(p)
    got = []
    for parts in by.values():
        parts.sort(key=lambda p: p["start"])
        ids = np.frombuffer(b"".join(bytes(p["ids"]) for p in parts), "<u4").tolist()
        assert [p["start"] for p in parts] == np.cumsum([0, *(p["length"] for p in parts)])[:-1].tolist()
        assert all(len(p["ids"]) == 4 * p["length"] > 0 and p["doc_tokens"] == len(ids) for p in parts)
        got.append((parts[0]["doc_id"], ids))
    want = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda p: p["offset"])
        ends = np.cumsum([0, *(p["length"] for p in parts)]).tolist()
        assert [p["offset"] for p in parts] == ends[:-1] and ends[-1] <= window
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else window - ends[-1]
    return padding


def test_documents(docs, wide_docs, doc_rows, tokenizer):
    assert check(docs, doc_rows, tokenizer) == 0
    assert check(wide_docs, doc_rows, tokenizer) == 0


@pytest.mark.parametrize("block", [1, 3, 50_000])
def test_small_windows_and_rank_blocks(spark, monkeypatch, tokenizer, block):
    monkeypatch.setattr(P, "RANK_BLOCK", block)
    rng = random.Random(block)
    rows = [(i, " ".join(words(i, rng.choice([0, 1, 7, 7, 7, rng.randrange(90)]))), None, None, None) for i in range(80)]
    assert check(spark.createDataFrame(rows, SCHEMA), rows, tokenizer, window=16) == 0


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 20)
    monkeypatch.setattr(P, "CACHE_PARTS", 20)
    encode = P.Encoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    texts = [
        "Don't we're 's it's. x<|endoftext|>y, <|startoftext|> a|b ΑΣ İ ẞ é́ ́ cd\tef\x1cgh 12,5 l'été ...", "", " ", "\n\n", None,
        "GROSS Straße ÀÉÎ ÿŸ µ ½ ª", " x　y\x85z w", "a.b.c!!! &&& <|> ~~ '' ' '", "漢字 かな 한글", "x" * 5000,
    ]
    for t in texts + [" ".join(words(s, 100)) for s in range(5)]:
        assert np.frombuffer(encode(t), "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [1], t


def test_encoder_on_letters_that_change_with_case(tokenizer):
    """A dotted capital I is a letter and a mark in lower case, and the mark joins what follows."""
    encode = P.Encoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    texts = [w + m for w in ("İ", "kİ", "İx", "ǰİ", "ΑΣ", "ΐ", "ẞ") for m in ("", *P.Encoder.MARKS, "...", "!?")]
    rng = random.Random(3)
    odd = list("İIıiΣσςßẞǅŉΐﬁK.,!'-_ \n1éÉ́̇<|>") + ["<|endoftext|>", "'s", "'LL"]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randrange(1, 25))) for _ in range(4000)] + [" ".join(texts)]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_encoder_meets_special_tokens_by_case(tokenizer):
    encode = P.Encoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    forms = ["endoftext", "EndOfText", "ENDOFTEXT", "startoftext", "StartOfText", "STARTOFTEXT"]
    texts = [t for f in forms for t in (f"<|{f}|>", f"A Word<|{f}|>Y, <|{f}|> End", f"Été <|{f}|>. x", f"ΑΣ<|{f}|>")]
    for t in [*texts, " ".join(texts), *reversed(texts)]:
        assert np.frombuffer(encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_least_squares_on_histograms_with_known_answers():
    patterns = [(9, 7), (8, 8), (10, 3, 3)]
    counts = {9: 5, 7: 5, 8: 6, 10: 4, 3: 8}
    assert np.allclose(P.repeat_counts(patterns, counts, 16), [5, 3, 4], atol=1e-3)
    assert np.allclose(P.repeat_counts([(9, 7)], {9: 4, 7: 0}, 16), [2], atol=1e-3)


@pytest.mark.parametrize("seed", range(20))
def test_layout_places_every_token_once(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 16, 64])
    counts = {n: rng.choice([1, 3, 200]) for n in range(1, window) if rng.random() < 0.5}
    plan, made = P.layout(counts, window)
    filled, seen = defaultdict(set), defaultdict(set)
    for cls, lo, hi, start, size, sequence, offset in plan:
        for r in range(lo, hi):
            at = set(range(offset, offset + size))
            assert not at & filled[sequence + r - lo]
            filled[sequence + r - lo] |= at
            part = set(range(start, start + size))
            assert not part & seen[cls, r]
            seen[cls, r] |= part
    assert all(seen[n, r] == set(range(n)) for n, c in counts.items() for r in range(c)) and len(seen) == sum(counts.values())
    sizes = [len(x) for x in filled.values()]
    assert sorted(filled) == list(range(made)) and all(x == set(range(len(x))) for x in filled.values())
    assert all(n == window or n & (n - 1) == 0 for n in sizes)


def test_no_documents(no_docs):
    assert P.pack(no_docs).count() == 0
