"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few shape features. Training boosts shallow trees one
feature at a time, in turn (cyclic), on the logistic loss; the trees of one
feature add up to one lookup table over its bins, those of a feature pair to
one two-way table. A score is the sigmoid of the sum of table entries, so
scoring a batch is a few array additions.

Cases: a null text counts as empty; empty texts get the score of the bins
that zero features fall in; repeated rows are scored each; without labels of
both kinds the model is the (smoothed) share of 1. Texts are read whole.
Columns beside doc_id and text are carried or ignored, never read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import column_function, fold, labelled_rows, sample_labels, sigmoid, text_bytes, whole_text

#: Most labelled rows that a fit learns from.
SAMPLE_ROWS = 20_000
FEATURES = ["log_words", "mean_word", "long_words", "upper", "digit", "marks", "pipes", "stops", "non_ascii", "distinct",
            "echo", "distinct_pairs", "repeated_lines", "top_word", "words_per_line", "symbol_words"]


def _classes() -> np.ndarray:
    """256 x 6: which byte counts as upper case, digit, mark, pipe, sentence
    mark or non-ASCII."""
    m = np.zeros((256, 6))
    for k, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>!{}[]=_^~\\", b"|", b".,;:?")):
        m[list(chars), k] = 1
    m[128:, 5] = 1
    return m


def _shape(b: bytes, classes: np.ndarray) -> list[float]:
    words = b.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    chars = max(1, int(counts.sum()))
    upper, digit, marks, pipes, stops, high = (counts @ classes) / chars
    lengths = np.fromiter(map(len, words), np.int64, n)
    kinds = Counter(words)
    lines = [x for x in b.split(b"\n") if x.strip()]
    ends = np.fromiter((w[-1] for w in words), np.uint8, n)
    pairs = len(set(zip(words, words[1:], strict=False)))
    echo = sum(map(bytes.__eq__, words, words[1:]))
    return [float(np.log1p(n)), float(lengths.mean()), float((lengths > 14).mean()), upper, digit, marks, pipes, stops, high,
            len(kinds) / n, echo / n, pairs / max(1, n - 1), 1 - len(set(lines)) / max(1, len(lines)), max(kinds.values()) / n,
            float(np.log1p(n / len(lines))), float(classes[ends, 2].mean())]


def _make_features():
    classes = _classes()

    def apply(batch: pa.Array) -> pa.Array:
        return pa.array([_shape(b, classes) for b in text_bytes(batch)], pa.list_(pa.float64()))
    return apply


def features(text: Column) -> Column:
    """The shape features of a text as array<double>, in the order of FEATURES."""
    return column_function(_make_features, "array<double>")(text)


@dataclass
class AdditiveModel:
    """Bin edges per feature, a table per feature, a table per feature pair."""
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]  # i, j, coarse bin of i's bins, of j's, table

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]
        for b, t in zip(bins, self.tables, strict=True):
            out += t[b]
        for i, j, ci, cj, t in self.pairs:
            out += t[ci[bins[i]], cj[bins[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Leaf values of a tree over ordered bins with gradient sums g and
    curvature sums h: splits greedily, ``depth`` levels."""
    out = np.zeros(len(g))

    def grow(a: int, b: int, left: int) -> None:
        gs, hs = g[a:b].sum(), h[a:b].sum()
        if left and b - a > 1:
            cg, ch = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gain = cg ** 2 / (ch + ridge) + (gs - cg) ** 2 / (hs - ch + ridge)
            k = int(np.argmax(gain))
            if gain[k] > gs ** 2 / (hs + ridge) + 1e-9:
                grow(a, a + k + 1, left - 1)
                grow(a + k + 1, b, left - 1)
                return
        out[a:b] = gs / (hs + ridge)
    grow(0, len(g), depth)
    return out


def _quad(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of a two-way table into four quadrants, and its values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    a, ha = cg[:-1, :-1], ch[:-1, :-1]
    r, hr = cg[:-1, -1:], ch[:-1, -1:]
    c, hc = cg[-1:, :-1], ch[-1:, :-1]
    parts = [(a, ha), (r - a, hr - ha), (c - a, hc - ha), (tg - r - c + a, th - hr - hc + ha)]
    gain = sum(x ** 2 / (y + ridge) for x, y in parts)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [x[i, j] / (y[i, j] + ridge) for x, y in parts]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return float(gain[i, j] - tg ** 2 / (th + ridge)), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, pair_rounds: int = 30, n_pairs: int = 6, bins: int = 48, coarse: int = 8,
        rate: float = 0.15, ridge: float = 5.0, depth: int = 2) -> AdditiveModel:
    """Cyclic boosting: ``rounds`` passes over all features, then the pairs of
    the largest gain on what is left, ``pair_rounds`` passes over those."""
    f = len(FEATURES)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = AdditiveModel(float(np.log(share / (1 - share))), [np.zeros(0)] * f, [np.zeros(1)] * f, [])
    if len(y) == 0 or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(f)]
    index = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    m = np.full(len(y), model.base)
    for _ in range(rounds):
        for k in range(f):
            p = sigmoid(m)
            t = rate * _tree(np.bincount(index[k], y - p, len(model.tables[k])), np.bincount(index[k], p * (1 - p), len(model.tables[k])), depth, ridge)
            model.tables[k] += t
            m += t[index[k]]
    maps = [np.arange(len(t)) * coarse // len(t) for t in model.tables]

    def sums(i: int, j: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(maps[i][index[i]] * coarse + maps[j][index[j]], values, coarse * coarse).reshape(coarse, coarse)
    p = sigmoid(m)
    gains = sorted(((_quad(sums(i, j, y - p), sums(i, j, p * (1 - p)), ridge)[0], i, j) for i in range(f) for j in range(i)), reverse=True)
    model.pairs = [(i, j, maps[i], maps[j], np.zeros((coarse, coarse))) for _, i, j in gains[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, ci, cj, t in model.pairs:
            p = sigmoid(m)
            step = rate * _quad(sums(i, j, y - p), sums(i, j, p * (1 - p)), ridge)[1]
            t += step
            m += step[ci[index[i]], cj[index[j]]]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 5, held_out: int = 0, bound: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fits on at most ``bound`` labelled rows outside the held-out fold."""
    rows = labelled_rows(docs, sample_labels(labels, label, mod, held_out, bound), features(F.col("text"))).toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    y = rows["label"].to_numpy(float)
    order = np.lexsort([*x.T[::-1], y])  # rows arrive in any order; sums must not depend on it
    return fit(x[order], y[order])


def score(text: Column, model: AdditiveModel) -> Column:
    """Probability of label 1 for each text."""
    def make():
        classes = _classes()

        def apply(batch: pa.Array) -> pa.Array:
            x = np.array([_shape(b, classes) for b in text_bytes(batch)]).reshape(len(batch), len(FEATURES))
            return pa.array(model.score(x), pa.float64())
        return apply
    return column_function(make, "double")(text)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, mod: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) per document."""
    model = train(docs, labels, "quality", mod, held_out)
    scored = docs.select("doc_id", score(whole_text(), model).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), mod) == held_out).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, mod: int = 5, held_out: int = 0) -> DataFrame:
    """The documents with a score of at least ``threshold``, all columns."""
    model = train(docs, labels, "quality", mod, held_out)
    return docs.where(score(whole_text(), model) >= threshold)
