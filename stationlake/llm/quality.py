"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds cut its score: P(grade > k) = sigmoid(score - threshold_k).  The
model gives an expected grade and a tail probability P(grade >= g), by which
documents are selected.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hashed feature space.
DIMS = 1 << 18
#: Labelled documents that the model is fitted on at most (those of the smallest hashes).
SAMPLE_ROWS = 6000
#: Features seen in fewer documents of the sample are left at weight zero.
LEAST_DOCS = 8
GRADES = 3
#: A document is kept from this probability of the best grade on.
KEEP_FROM = 0.5
#: Shares of words from which a shape counts as present.
LEVELS = (0.01, 0.03, 0.1, 0.3)
L2 = 5e-4
ROUNDS = 300
SEED = 17
CACHE_WORDS = 200_000


def _slot(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode(), SEED) % DIMS


def _is_mark(ch: str) -> bool:
    return not ch.isalnum()


@functools.lru_cache(maxsize=CACHE_WORDS)
def word_features(word: str) -> tuple[int, tuple[int, ...]]:
    """(slot of the bare word, slots of its shape): end marks, case, letters at all."""
    start, end = 0, len(word)
    while end > start and _is_mark(word[end - 1]):
        end -= 1
    while start < end and _is_mark(word[start]):
        start += 1
    core, tail = word[start:end], word[end:]
    shape = []
    if len(tail) > 1 or (tail and tail not in ".,;:!?"):
        shape.append(_slot(f"tail {tail[:4]}"))
        shape.append(_slot("odd tail"))
    if not core:
        shape.append(_slot("no letters"))
    elif len(core) > 1 and core == core.upper() and core != core.lower():
        shape.append(_slot("capitals"))
    if any(c.isdigit() for c in core):
        shape.append(_slot("digits"))
    return _slot(f"word {unicodedata.normalize('NFC', core).lower()}"), tuple(shape)


@functools.lru_cache(maxsize=4096)
def _level(slot: int, share: float) -> int:
    return _slot(f"{slot} at {share}")


_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_REPEATED, _DISTINCT, _LENGTH = _slot("same as before"), _slot("distinct words"), _slot("log words")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(slots, values) of a whole text: words that occur; shares of shapes and repeats, also by level.

    No words: None.
    """
    words = [w for w in _SPACES.split(text or "") if w]
    if not words:
        return None
    n, shares = len(words), Counter()
    present = set()
    for w, k in Counter(words).items():
        slot, shape = word_features(w)
        present.add(slot)
        for s in shape:
            shares[s] += k
    shares[_REPEATED] = sum(map(str.__eq__, words, words[1:]))
    shares[_DISTINCT] = len(present)
    present |= {_level(s, x) for s, v in shares.items() for x in LEVELS if v >= x * n}
    slots = np.fromiter([*present, *shares, _LENGTH], np.int64)
    values = np.ones(len(slots))
    values[len(present) : -1] = [4.0 * v / n for v in shares.values()]
    values[-1] = np.log1p(n) / 8
    return slots, values


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: str | None) -> tuple[float, float]:
        """(expected grade, probability of the best grade); a text without words has 0, 0."""
        made = features(text)
        if made is None:
            return 0.0, 0.0
        above = 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[made[0]] @ made[1], -40, 40)))
        return float(above.sum()), float(above[-1])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int = GRADES) -> OrdinalModel:
    """Maximum penalised likelihood by Adam over the whole sample; ``rows``: (grade, slots, values)."""
    weights, thresholds = np.zeros(DIMS), np.linspace(-1.0, 1.0, grades - 1) if grades > 2 else np.zeros(1)
    if not rows:
        return OrdinalModel(weights, thresholds)
    grade = np.array([g for g, _, _ in rows])
    owner = np.repeat(np.arange(len(rows)), [len(s) for _, s, _ in rows])
    slots, values = np.concatenate([s for _, s, _ in rows]), np.concatenate([v for _, _, v in rows])
    seen = np.bincount(slots, minlength=DIMS)
    used = np.flatnonzero(seen >= min(LEAST_DOCS, max(1, len(rows) // 4)))
    place = np.full(DIMS, -1)
    place[used] = np.arange(len(used))
    keep = place[slots] >= 0
    owner, slots, values = owner[keep], place[slots[keep]], values[keep]
    w, first, gaps = np.zeros(len(used)), thresholds[:1].copy(), np.zeros(grades - 2)
    params = [w, first, gaps]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    at = np.arange(len(rows))
    for t in range(1, ROUNDS + 1):
        cuts = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
        f = np.bincount(owner, weights=w[slots] * values, minlength=len(rows))
        above = np.hstack([np.ones((len(rows), 1)), _sigmoid(f[:, None] - cuts), np.zeros((len(rows), 1))])
        chance = np.maximum(above[at, grade] - above[at, grade + 1], 1e-9)
        slope = above * (1 - above)
        df = (slope[at, grade] - slope[at, grade + 1]) / chance
        # d chance / d cut: the lower cut of a grade takes from it, the upper adds.
        dc = np.zeros((len(rows), grades + 1))
        dc[at, grade] -= slope[at, grade] / chance
        dc[at, grade + 1] += slope[at, grade + 1] / chance
        dc = dc[:, 1:-1].mean(axis=0)
        back = np.cumsum(dc[::-1])[::-1]
        slopes = [
            -np.bincount(slots, weights=df[owner] * values, minlength=len(used)) / len(rows) + L2 * w,
            -back[:1],
            -back[1:] * np.exp(gaps),
        ]
        for p, m, s, g in zip(params, means, squares, slopes):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= 0.08 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    weights[used] = w
    return OrdinalModel(weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))]))


def _feature_rows(batches):
    for b in batches:
        made = [(g, features(t)) for g, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        made = [(g, *m) for g, m in made if m is not None]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([g for g, _, _ in made], pa.int32()),
                pa.array([s.astype("<u4").tobytes() for _, s, _ in made], pa.binary()),
                pa.array([v.astype("<f4").tobytes() for _, _, v in made], pa.binary()),
            ],
            ["grade", "slots", "vals"],
        )


def grades_from_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, grade``: one point for quality, one for not being toxic.

    Rows with a null are no rating; of several ratings of a document the lowest counts.
    """
    rated = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    grade = F.when(F.col("quality") > 0, 1).otherwise(0) + F.when(F.col("toxic") > 0, 0).otherwise(1)
    return rated.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on the SAMPLE_ROWS rated documents whose hashed ids are smallest (all, if fewer).

    Features are made by the tasks; the driver gets the sample's hashed
    features only.  Without ratings the model has weight zero everywhere.
    """
    sample = ratings.select(F.col("doc_id").alias("rated"), "grade").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    # At most SAMPLE_ROWS rows; a doc_id that occurs again counts once, with its least text.
    rows = docs.join(F.broadcast(sample), F.col(id_col) == F.col("rated"))
    rows = rows.groupBy("rated", "grade").agg(F.min(text_col).alias("text"))
    rows = rows.select("grade", "text").mapInArrow(_feature_rows, "grade INT, slots BINARY, vals BINARY").collect()
    # Sorted, so that the sums don't depend on the order of the tasks.
    rows = sorted((r["grade"], bytes(r["slots"]), bytes(r["vals"])) for r in rows)
    return fit_ordinal([(g, np.frombuffer(s, "<u4").astype(np.int64), np.frombuffer(v, "<f4").astype(float)) for g, s, v in rows])


def _scorer(model: OrdinalModel):
    used = np.flatnonzero(model.weights)
    small = (used.astype(np.uint32), model.weights[used], model.thresholds)

    def run(texts):
        weights = np.zeros(DIMS)
        weights[small[0]] = small[1]
        whole = OrdinalModel(weights, small[2])
        for part in texts:
            made = [whole.score(t) for t in part.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([x for x, _ in made], pa.float64()), pa.array([x for _, x in made], pa.float64())],
                ["expected_grade", "tail_probability"],
            )

    return run


def scored(docs: DataFrame, model: OrdinalModel, text_col: str = "text", name: str = "quality_score") -> DataFrame:
    """``docs`` and a struct column ``name`` of (expected_grade, tail_probability)."""
    run = _scorer(model)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(texts)

    udf = F.arrow_udf(score, "struct<expected_grade: double, tail_probability: double>")
    return docs.withColumn(name, udf(F.col(text_col)))


def classify(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: ``doc_id, expected_grade, tail_probability, kept``.

    ``expected_grade`` lies in 0 to GRADES - 1; a document is kept when its
    probability of the best grade is ``keep_from`` or more.  A null, empty or
    blank text has 0, 0 and is rejected.  Equal texts get equal scores; null
    and repeated doc_ids are judged like others; an empty table gives no rows;
    without ratings every text gets the same even score.  Whole texts are read;
    other columns of ``docs`` are not used.
    """
    model = train(docs, ratings, id_col, text_col)
    rows = scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return rows.select(
        "doc_id",
        "quality_score.expected_grade",
        "quality_score.tail_probability",
        (F.col("quality_score.tail_probability") >= keep_from).alias("kept"),
    )
