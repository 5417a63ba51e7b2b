"""Small document tables, and the order of their rows."""

import random

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Columns whose names the operators use inside.
CLASHING = ", ord STRING, row_key STRING, fp STRING, spans STRING, grp STRING, digit STRING, name STRING, h STRING, cls STRING, take STRING, cut STRING"


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def document_rows() -> list[tuple]:
    """Copies, near copies, shared passages, odd spaces, nulls, blanks, a very long text, repeated rows."""
    base = " ".join(words(1, 300))
    passage = " ".join(words(2, 60))
    near = base.split()
    near[150] = "changed"
    texts = [
        base,
        base,
        base.replace(" ", "  \n", 5) + " ",
        " ".join(near),
        " ".join(words(3, 100)) + " " + passage + " " + " ".join(words(4, 80)),
        passage + " " + " ".join(words(5, 40)),
        " ".join(words(6, 30)) + " " + passage,
        "short text",
        "short  text",
        "",
        " \n\t ",
        None,
        "é" * 60 + " ünïcode " + "漢字 " * 40,
        "na na " * 200,
        " ".join(words(7, 60_000, 5000)),
    ]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("src0", "src1", "src7", None)[i % 4], 0 if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows += [(None, base, None, None, None), (None, None, None, None, None), (100, "short text", "en", "src0", 10)]
    return rows


def in_order(rows: list[tuple]) -> list[tuple[int, tuple]]:
    """Rows by doc_id, null last, repeated ones as they come: (position, row)."""
    return sorted(enumerate(rows), key=lambda p: (p[1][0] is None, p[1][0] or 0, p[0]))
