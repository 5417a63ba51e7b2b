"""Language identification by a byte convolutional network.

Filters of several widths run over the bytes of fixed-length windows; each
filter's largest response in a window feeds a softmax over the languages.  The
network is trained in numpy on a bounded sample and applied to batches of
windows that cover every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a window; the last window of a text is padded with zeros.
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: The sample: documents of a language, windows of a document.
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 4
EPOCHS = 12
BATCH = 64
RATE = 0.01
SEED = 11
#: Windows that are convolved at once.
BLOCK = 1024
UNKNOWN = "und"


@dataclass(frozen=True)
class ByteNet:
    """``taps[w][k]``: responses of the filters of width w to the byte at place k (256 x FILTERS)."""

    languages: list[str]
    taps: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    shift: np.ndarray


def cut_windows(raw: bytes) -> np.ndarray:
    """All windows of a text, one after another."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_net(languages: list[str], windows: np.ndarray, labels: np.ndarray) -> ByteNet:
    """Adam on the cross entropy; only the place of each largest response gets a gradient."""
    rng = np.random.default_rng(SEED)
    n_pool, n_lang = FILTERS * len(WIDTHS), len(languages)
    taps = {w: rng.normal(0, 0.5 / np.sqrt(w), (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    bias = np.zeros(n_pool, np.float32)
    dense = rng.normal(0, 1 / np.sqrt(n_pool), (n_pool, n_lang)).astype(np.float32)
    shift = np.zeros(n_lang, np.float32)
    params = [*taps.values(), bias, dense, shift]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS if n_lang > 1 and len(windows) else 0):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            x, y = windows[order[at : at + BATCH]], labels[order[at : at + BATCH]]
            pooled, places = [], []
            for w in WIDTHS:
                z = sum(taps[w][k][x[:, k : WINDOW - w + 1 + k]] for k in range(w))
                places.append(z.argmax(axis=1))
                pooled.append(np.take_along_axis(z, places[-1][:, None, :], axis=1)[:, 0])
            pre = np.hstack(pooled) + bias
            act = np.maximum(pre, 0)
            p = _softmax(act @ dense + shift)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ dense.T) * (pre > 0)
            slopes = []
            rows, cols = np.arange(len(y))[:, None], np.arange(FILTERS)[None, :]
            for i, w in enumerate(WIDTHS):
                g, part = np.zeros_like(taps[w]), back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(w):
                    np.add.at(g[k], (x[rows, places[i] + k], np.broadcast_to(cols, part.shape)), part)
                slopes.append(g)
            slopes += [back.sum(axis=0), act.T @ p, p.sum(axis=0)]
            step += 1
            for q, m, s, g in zip(params, means, squares, slopes):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                q -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return ByteNet(languages, taps, bias, dense, shift)


class Reader:
    """Applies a net: the taps of two neighbouring places are added beforehand for every byte pair."""

    def __init__(self, net: ByteNet):
        self.net = net
        self.parts = {}
        for w in WIDTHS:
            t = net.taps[w]
            pairs = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(1 << 16, FILTERS) for k in range(0, w - 1, 2)]
            self.parts[w] = (pairs, t[w - 1] if w % 2 else None)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(windows), BLOCK):
            x = windows[at : at + BLOCK].T.astype(np.intp)
            pair = x[:-1] * 256 + x[1:]
            pooled = []
            for w in WIDTHS:
                pairs, last = self.parts[w]
                best = np.full((x.shape[1], FILTERS), -np.inf, np.float32)
                z, more = np.empty_like(best), np.empty_like(best)
                for t in range(WINDOW - w + 1):
                    np.take(pairs[0], pair[t], axis=0, out=z, mode="clip")
                    for j in range(1, len(pairs)):
                        np.add(z, np.take(pairs[j], pair[t + 2 * j], axis=0, out=more, mode="clip"), out=z)
                    if last is not None:
                        np.add(z, np.take(last, x[t + w - 1], axis=0, out=more, mode="clip"), out=z)
                    np.maximum(best, z, out=best)
                pooled.append(best)
            out.append(_softmax(np.maximum(np.hstack(pooled) + self.net.bias, 0) @ self.net.dense + self.net.shift))
        return np.concatenate(out) if out else np.empty((0, len(self.net.languages)))

    def read(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """(language, probability) of each text: its windows' probabilities by their share of the bytes."""
        cut = [cut_windows(t) for t in texts]
        counts = np.array([len(c) for c in cut])
        weight = np.full(counts.sum(), float(WINDOW))
        ends = np.cumsum(counts)
        weight[ends - 1] = [max(1, len(t) - (n - 1) * WINDOW) for t, n in zip(texts, counts)]
        p = self.probabilities(np.concatenate(cut)) * weight[:, None]
        p = np.add.reduceat(p, ends - counts, axis=0) / np.add.reduceat(weight, ends - counts)[:, None]
        best = p.argmax(axis=1)
        return [(self.net.languages[i], min(1.0, float(row[i]))) for i, row in zip(best, p)]


def _sample_windows(batches):
    for b in batches:
        langs, hashes, cuts = [], [], []
        for raw, lang, h in zip(*(b.column(i).to_pylist() for i in range(3))):
            cut = cut_windows(raw)
            for i in sorted({len(cut) * j // SAMPLE_WINDOWS for j in range(SAMPLE_WINDOWS)}):
                langs.append(lang)
                hashes.append(h)
                cuts.append(cut[i].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(cuts, pa.binary())], ["lang", "h", "cut"]
        )


def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text leaves 1 modulo 3."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteNet:
    """Fit on at most SAMPLE_DOCS documents of each language, those of the smallest hashed ids.

    Only documents with a text, a language and a doc_id that is not held out
    are learned from, by at most SAMPLE_WINDOWS windows of each, spread evenly
    over its text.  Every language met is learned, however rare.  Windows of the sample are cut by the tasks.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = rows.groupBy("lang").count().collect()  # one row per language, as many as the model has outputs
    if not counted:
        return train_net([UNKNOWN], np.empty((0, WINDOW), np.uint8), np.empty(0, int))
    # Below this hash lie about twice as many documents of the language as are wanted.
    line = [(r["lang"], int(min(1.0, 2 * SAMPLE_DOCS / r["count"]) * (2**62 - 1))) for r in counted]
    lines = docs.sparkSession.createDataFrame(line, "lang STRING, line LONG")
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 2)
    picked = (
        rows.withColumn("h", h).join(F.broadcast(lines), "lang").where("h <= line")
        .select(F.col("text").cast("binary").alias("text"), "lang", "h")
        .orderBy("h", "lang", "text").limit(4 * SAMPLE_DOCS * len(counted))
    )
    made = picked.mapInArrow(_sample_windows, "lang STRING, h LONG, cut BINARY").collect()
    by_lang: dict[str, list] = {}
    for r in sorted(made, key=lambda r: (r["h"], r["lang"], r["cut"])):
        part = by_lang.setdefault(r["lang"], [])
        if len(part) < SAMPLE_DOCS * SAMPLE_WINDOWS:
            part.append(bytes(r["cut"]))
    languages = sorted(by_lang)
    cuts = [c for lang in languages for c in by_lang[lang]]
    labels = np.repeat(np.arange(len(languages)), [len(by_lang[lang]) for lang in languages])
    return train_net(languages, np.frombuffer(b"".join(cuts), np.uint8).reshape(-1, WINDOW), labels)


def _predictor(net: ByteNet):
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(net)
        for part in texts:
            langs, scores = [], []
            for at in range(0, len(part), 256):
                raw = part.slice(at, 256).to_pylist()
                there = [t for t in raw if t is not None]
                read = iter(reader.read(there) if there else [])
                for t in raw:
                    lang, score = (UNKNOWN, 0.0) if t is None else next(read)
                    langs.append(lang)
                    scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict


def identify(docs: DataFrame, net: ByteNet, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` and a struct column ``name`` of (lang, score); null and letterless texts: ``und``, 0."""
    predict = F.arrow_udf(_predictor(net), "struct<lang: string, score: double>")
    readable = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col).cast("binary"))
    return docs.withColumn(name, predict(readable))


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    A null text, or one without a letter, is ``und`` with score 0.  A null
    doc_id is not held out, and not learned from either; repeated rows are
    judged alike.  If one language is learned, all else is that language; if
    none is, everything is ``und``.  An empty table gives no rows; other
    columns of ``docs`` are not used.  The text alone decides a prediction.
    """
    net = train(docs, id_col, text_col, lang_col)
    rows = identify(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), net)
    return rows.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
    )
