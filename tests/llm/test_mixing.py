"""Mixing against a plain water-filling and plain prefixes."""

import hashlib
import re
from fractions import Fraction

import pytest
from cases import words

from stationlake.llm import mixing as M

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def domain(source):
    number = re.search("([0-9]{1,9})$", source or "")
    return ("web", "books", "code", "news")[int(number[1]) % 4 if number else 0]


def fill(budget, children):
    """children: name -> (weight, cap); shares by weight, shortages to the others, whole tokens by running sums."""
    order = sorted(children, key=lambda n: (children[n][1] / children[n][0], n))
    full, rest = {}, budget
    for i, n in enumerate(order):
        w = sum(children[m][0] for m in order[i:])
        if children[n][1] <= Fraction(rest * children[n][0], w):
            full[n], rest = children[n][1], rest - children[n][1]
        else:
            break
    open_, out, upto = [n for n in order if n not in full], dict(full), 0
    total = sum(children[n][0] for n in open_)
    for n in open_:
        out[n] = rest * (upto + children[n][0]) // total - rest * upto // total
        upto += children[n][0]
    return out


def plain(rows, weights, target, epochs):
    weight = lambda path: weights.get(path, M.DEFAULT_WEIGHT)
    docs = []
    for r in rows:
        n = len(re.findall(M.WORD, r[1] or ""))
        if n:
            docs.append((r[0], (domain(r[3]), r[2] or M.NONE, r[3] or M.NONE), n))
    leaves = {}
    total = 0
    for _, leaf, n in docs:
        total += n
        leaves[leaf] = leaves.get(leaf, 0) + n
    leaves = {k: v for k, v in leaves.items() if all(weight(k[:d]) > 0 for d in (1, 2, 3))}
    shares = {(): total * target[0] // target[1]}
    for depth in (1, 2, 3):
        for parent in [p for p in shares if len(p) == depth - 1]:
            kids = {}
            for leaf, n in leaves.items():
                if leaf[: depth - 1] == parent:
                    w, cap = kids.get(leaf[:depth], (weight(leaf[:depth]), 0))
                    kids[leaf[:depth]] = (w, cap + n * epochs)
            shares |= fill(shares[parent], kids)
    out = []
    for leaf, tokens in leaves.items():
        whole, due = divmod(shares[leaf], tokens)
        mine = [d for d in docs if d[1] == leaf]
        out += [(d[0], *leaf, d[2], e, d[2]) for d in mine for e in range(1, whole + 1)]
        key = lambda d: (hashlib.md5(f"{M.SEED}:{whole + 1}:{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[0] is None, d[0] or 0)  # noqa: E731,B023
        for d in sorted(mine, key=key):
            if due <= 0:
                break
            out.append((d[0], *leaf, d[2], whole + 1, min(due, d[2])))
            due -= d[2]
    return sorted(map(repr, out))


def got(frame, spark, weights, **options):
    rows = M.mix(frame, M.weights_frame(spark, weights) if weights else None, **options).collect()
    return sorted(repr((r["doc_id"], r["domain"], r["lang"], r["source"], r["n_tokens"], r["epoch"], r["take_tokens"])) for r in rows)


@pytest.mark.parametrize("target,weights", [((1, 2), M.WEIGHTS), ((3, 1), M.WEIGHTS), ((9, 1), M.WEIGHTS),
                                            ((1, 3), {("web",): 0, ("books", "en"): 7, ("books", "en", "src1"): 3, ("code",): 1})])
def test_many_leaves(spark, monkeypatch, target, weights):
    monkeypatch.setattr(M, "DIGITS", 1)
    rows = [(i, " ".join(words(i, (i * 7919) % 60)), ("en", "de", "fr")[i * i % 3], f"src{(i * i) % 11}", 0) for i in range(150)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(frame, spark, weights, target=target, max_epochs=4) == plain(rows, weights, target, 4)


def test_documents_with_odd_rows(spark, docs, wide_docs, doc_rows):
    want = plain(doc_rows, M.WEIGHTS, M.TARGET, M.MAX_EPOCHS)
    assert got(docs, spark, None) == want == got(wide_docs, spark, None)


def test_mixed_documents_are_cut_after_their_last_word(spark, docs, wide_docs, doc_rows):
    for frame in (docs, wide_docs):
        out = M.mixed_documents(frame, target=(1, 100))
        assert out.columns == frame.columns
        rows = out.collect()
        used = M.mix(frame, target=(1, 100)).collect()
        count = lambda t: len(re.findall(M.WORD, t))
        assert sorted(count(r["text"]) for r in rows) == sorted(r["take_tokens"] for r in used)
        texts = [r[1] for r in doc_rows if r[1]]
        assert all(any(t.startswith(r["text"]) for t in texts) for r in rows)
        assert any(r["n_chars"] == len(r["text"]) for r in rows)


def test_no_documents(no_docs):
    assert M.mix(no_docs).count() == 0 and M.mixed_documents(no_docs).count() == 0
