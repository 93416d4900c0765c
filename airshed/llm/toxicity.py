"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words (runs of letters, lower-cased) and their
prefixes of PREFIXES bytes, so that forms of a stem share a term; each is a
64-bit hash, and a text has a term or hasn't. The model is a bias, a weight
per term and a small vector per term; the inner product of two terms'
vectors is the weight of their meeting in a text (an insult and a group, say),
which linear weights can't express. All pairs of a text cost one pass over
its terms: half the squared length of the vectors' sum less the sum of their
squared lengths.

Learning: at most SAMPLE_ROWS labelled texts; Spark counts in how many of
them each term is, in all and with label 1; of those in MIN_TEXTS or more
that lean to either label by MIN_LIFT standard deviations, the VOCABULARY that
lean most become the model's terms (the rest only add noise that grows with the
length of a text). Terms that lean to 0 are among them: a word that excuses
another one acts through its pair alone. Numpy fits it on the driver by Adagrad
on the logistic loss, in an order that the ids fix. Scoring looks each word up once
per task and remembers it, within a bound.

Cases: a null text counts as empty; a text without known terms gets the
sigmoid of the bias; repeated rows are scored each; without labels of both
kinds the score is the smoothed share of 1. Texts are read whole, very long
ones too: a text holds its distinct words once. Labels, lang, source and doc_id
are no inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import column_function, fold, sample_labels, sigmoid, text_bytes, whole_text
from airshed.session import materialize

SAMPLE_ROWS = 20_000
VOCABULARY = 1 << 17
MIN_TEXTS = 8
#: Standard deviations by which a term's label-1 texts must miss or exceed their share.
MIN_LIFT = 2.0
PREFIXES = (4, 5, 6, 7)
FACTORS = 4
#: Words that a task remembers.
REMEMBERED = 200_000

_WORD = re.compile(rb"[a-z\x80-\xff]+")


def _word_terms(word: bytes) -> list[int]:
    """The hashes of a word and of its proper prefixes, as signed 64-bit."""
    digest = xxhash.xxh64_intdigest
    return [digest(word, 0) - (1 << 63), *(digest(word[:n], n) - (1 << 63) for n in PREFIXES if n < len(word))]


def _terms(text: bytes) -> set[int]:
    return {t for w in set(_WORD.findall(text.lower())) for t in _word_terms(w)}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n, n1): in how many of 512 texts each term is, and in how many
    with label 1."""
    slices = (batch.slice(k, 512) for batch in batches for k in range(0, batch.num_rows, 512))
    for batch in slices:
        found = [np.fromiter(t, np.int64, len(t)) for t in map(_terms, text_bytes(batch.column("text")))]
        label = np.repeat(batch.column("label").to_numpy(zero_copy_only=False) == 1, [len(x) for x in found])
        terms, at = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_inverse=True)
        n, n1 = np.bincount(at, minlength=len(terms)), np.bincount(at, label, len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n.astype(np.int64)), pa.array(n1.astype(np.int64))], ["term", "n", "n1"])


class _Lookup:
    """From a text to the indices of its terms in a sorted vocabulary."""

    def __init__(self, vocabulary: np.ndarray):
        self.index = {t: k for k, t in enumerate(vocabulary.tolist())}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        known, out = self.known, set()
        for w in set(_WORD.findall(text.lower())):
            ids = known.get(w)
            if ids is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                ids = known[w] = tuple(k for t in _word_terms(w) if (k := self.index.get(t)) is not None)
            out.update(ids)
        return np.sort(np.fromiter(out, np.int64, len(out)))


def indices(text: Column, vocabulary: np.ndarray) -> Column:
    """The sorted vocabulary indices of a text's terms, array<int>."""
    def make():
        look = _Lookup(vocabulary)

        def apply(batch: pa.Array) -> pa.Array:
            return pa.array([look(b).astype(np.int32) for b in text_bytes(batch)], pa.list_(pa.int32()))
        return apply
    return column_function(make, "array<int>")(text)


@dataclass
class FactorizationMachine:
    vocabulary: np.ndarray  # sorted term hashes
    bias: float
    weights: np.ndarray  # terms
    vectors: np.ndarray  # terms x factors

    def margin(self, ids: np.ndarray) -> float:
        v = self.vectors[ids]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[ids].sum() + 0.5 * (total @ total - (v * v).sum()))


def fit(flat: np.ndarray, sizes: np.ndarray, y: np.ndarray, vocabulary: np.ndarray, factors: int = FACTORS, epochs: int = 20, batch: int = 256,
        rate: float = 0.5, ridge: float = 2e-5, seed: int = 7) -> FactorizationMachine:
    """Adagrad on the logistic loss over mini-batches of whole texts; a text
    has ``sizes`` entries of ``flat``, the indices of its terms."""
    rng = np.random.default_rng(seed)
    n = len(vocabulary)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = FactorizationMachine(vocabulary, float(np.log(share / (1 - share))), np.zeros(n), rng.normal(0, 0.01, (n, factors)))
    if not n or not len(y) or y.min() == y.max():
        model.vectors[:] = 0
        return model
    starts = np.concatenate([[0], np.cumsum(sizes)])
    w, v = model.weights, model.vectors
    gw, gv, gb = np.full(n, 1e-3), np.full((n, factors), 1e-3), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            mine = order[k:k + batch]
            mine = mine[sizes[mine] > 0]
            if not len(mine):
                continue
            cols = np.concatenate([flat[starts[i]:starts[i + 1]] for i in mine])
            rows = np.repeat(np.arange(len(mine)), sizes[mine])
            at = np.concatenate([[0], np.cumsum(sizes[mine])[:-1]])
            vc = v[cols]
            total = np.add.reduceat(vc, at, axis=0)
            margin = model.bias + np.add.reduceat(w[cols], at) + 0.5 * ((total ** 2).sum(1) - np.add.reduceat((vc ** 2).sum(1), at))
            err = (sigmoid(margin) - y[mine]) / len(mine)
            terms, inv = np.unique(cols, return_inverse=True)
            e = err[rows]
            d = np.bincount(inv, e) + ridge * w[terms]
            gw[terms] += d * d
            w[terms] -= rate * d / np.sqrt(gw[terms])
            for f in range(factors):
                d = np.bincount(inv, e * (total[rows, f] - vc[:, f])) + ridge * v[terms, f]
                gv[terms, f] += d * d
                v[terms, f] -= 0.3 * rate * d / np.sqrt(gv[terms, f])
            d = err.sum()
            gb += d * d
            model.bias -= rate * d / np.sqrt(gb)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 3, held_out: int = 1, bound: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Fits on at most ``bound`` labelled rows outside the held-out fold; of
    rows that repeat an id, the smallest text counts."""
    sample = sample_labels(labels, label, mod, held_out, bound)
    hit = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")
    rows = materialize(hit.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("r")).select("doc_id", "r.text", "r.label"), "fm-sample")
    texts, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = ones / max(1, texts)
    counts = rows.select("text", "label").mapInArrow(_count_terms, "term bigint, n bigint, n1 bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    lift = (F.col("n1") - share * F.col("n")) / F.sqrt(F.col("n") * F.lit(max(1e-12, share * (1 - share))))
    top = counts.where(F.col("n") >= MIN_TEXTS).where(F.abs(lift) >= MIN_LIFT).orderBy(F.abs(lift).desc(), "term").limit(VOCABULARY).select("term").toPandas()
    vocabulary = np.sort(top["term"].to_numpy(np.int64))
    learned = rows.select("doc_id", "label", indices(F.col("text"), vocabulary).alias("ids")).toArrow()
    learned = learned.take(pa.array(np.argsort(learned.column("doc_id").to_numpy())))  # rows arrive in any order
    ids = learned.column("ids").combine_chunks()
    ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
    return fit(ids.flatten().to_numpy(zero_copy_only=False), np.diff(ids.offsets.to_numpy()), learned.column("label").to_numpy().astype(float), vocabulary)


def score(text: Column, model: FactorizationMachine) -> Column:
    """Probability of label 1 for each text."""
    def make():
        look = _Lookup(model.vocabulary)

        def apply(batch: pa.Array) -> pa.Array:
            return pa.array(sigmoid(np.array([model.margin(look(b)) for b in text_bytes(batch)], float)), pa.float64())
        return apply
    return column_function(make, "double")(text)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) per document."""
    model = train(docs, labels, "toxic", mod, held_out)
    scored = docs.select("doc_id", score(whole_text(), model).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), mod) == held_out).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
