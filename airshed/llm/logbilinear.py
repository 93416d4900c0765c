"""Language-model scores: a log-bilinear model by noise-contrastive estimation.

Tokens are the words of a text, A-Z lower-cased, and one end token. Every
training text is counted; the SHORT most frequent tokens are outputs of the
neural model, and all other words fall into GROUPS outputs by their form.
The model predicts a vector as the sum of the CONTEXT preceding tokens'
vectors, each through a matrix of its position; its inner product with an
output's vector plus a bias is the output's log weight. Scoring normalises
over all outputs (batched matrix products); a word of a group gets the
group's probability times its smoothed share of the group's counts, with one
place for unseen words. So token probabilities sum to one.

Each text is split into words twice: for the counts, and to write the numbers
of its outputs; learning and scoring read those.

Learning: training texts are cut in pieces of PIECE positions, with their
context, and dealt to shards by a hash of id and text; their number
follows from the counted tokens, and the order within one is that of the hash. In
round r of ROUNDS each shard takes the current model and learns, in numpy, from
the positions r, r + ROUNDS, ... of its pieces (noise is drawn from the counted
output frequencies and shared by a batch); the shards' models are averaged by
their tokens, in integers. So each position is learnt from once, work grows
with the corpus, and the model is a function of the table: files, partitions
and tasks don't move it.

Counts of frequent words (the COMMON most frequent) go to the tasks with the
function, at most that many; the rare words of a text are joined with the count table. So no
word that takes a large part of the corpus is a join key, and no word's
count is dropped.

Cases: a null text counts as empty, which is the end token alone; without
training texts the model is uniform over its outputs; repeated rows are
scored (and counted) each; other columns aren't read; texts are whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import repeat
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import column_function, fold, sigmoid, text_bytes, whole_text
from airshed.session import materialize

SHORT, GROUPS, DIMENSION, CONTEXT, ROUNDS = 360, 24, 16, 3, 2
NOISE, BATCH, RATE = 64, 2048, 0.15
COMMON = 100_000
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 150_000
#: The end token in tables; no word is empty.
END = ""
#: Positions of a piece of a text, and tokens of a shard at most (about half as many by hash).
PIECE, UNIT = 8192, 1 << 19
#: Models are averaged in steps of one over this.
_UNITS = 1 << 26
#: Tokens of one matrix product; its result then stays in a core's cache.
_SCORED = 1024


# How a word ends: 0 in a letter, 1 '.', 2 ',', 3 anything else.
_ENDS = [6 * (1 if b == 46 else 2 if b == 44 else 0 if b >= 128 or 97 <= b <= 122 else 3) for b in range(256)]
_SIZES = [0] * 5 + [1] * 4 + [2]


def forms_of(words: list[bytes]) -> list[int]:
    """The group of each word: how it ends, whether it is ASCII, its length."""
    return [_ENDS[w[-1]] + (0 if w.isascii() else 3) + (_SIZES[n] if (n := len(w)) < 10 else 2) for w in words]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, form, n); the end token has form -1."""
    count: Counter = Counter()
    ends = 0

    def out() -> pa.RecordBatch:
        words, n = [*count, b""], [*count.values(), ends]
        forms = [*forms_of(words[:-1]), -1]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(forms, pa.int32()),
                                           pa.array(n, pa.int64())], ["word", "form", "n"])
    for batch in batches:
        for text in text_bytes(batch.column("text")):
            count.update(words_of(text))
            ends += 1
            if len(count) > COUNTED:
                yield out()
                count.clear()
                ends = 0
    if ends:
        yield out()


def count_tokens(texts: DataFrame) -> DataFrame:
    """(word, form, c) of all tokens of ``texts.text``, written."""
    partial = texts.mapInArrow(_count, "word string, form int, n bigint")
    return materialize(partial.groupBy("word", "form").agg(F.sum("n").alias("c")), "lm-counts")


@dataclass
class Tokens:
    """What tasks need to number tokens: frequent words by rank, the output
    of each, and its count."""
    rank: dict[bytes, int]
    output: np.ndarray  # by rank
    log_count: np.ndarray  # log10(c + 1) by rank
    end: int  # rank of the end token, -1 where there are no training texts
    short: int

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.array(list(map(self.rank.get, words, repeat(-1))), np.int64)

    def outputs(self, ids: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The output of each token, and the words that have no rank."""
        out = self.output[ids] if len(self.output) else np.zeros(len(ids), np.int64)
        unknown = np.nonzero(ids < 0)[0]
        rare = [words[k] for k in unknown.tolist()]
        if rare:
            out[unknown] = self.short + np.array(forms_of(rare))
        return out, rare

    @property
    def end_output(self) -> int:
        return int(self.output[self.end]) if self.end >= 0 else self.short


@dataclass
class LogBilinear:
    context: np.ndarray  # outputs x d: vectors of tokens in a context
    place: np.ndarray  # CONTEXT x d x d
    target: np.ndarray  # outputs x d
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.place, self.target, self.bias)])

    def like(self, flat: np.ndarray) -> LogBilinear:
        parts, at = [], 0
        for x in (self.context, self.place, self.target, self.bias):
            parts.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return LogBilinear(*parts)

    def predict(self, before: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return sum(tables[i][before[:, i]] for i in range(CONTEXT))

    def log10(self, before: np.ndarray, output: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of outputs after their contexts."""
        tables = np.einsum("vd,cde->cve", self.context, self.place).astype(np.float32)
        out, weights, ones = np.empty(len(output)), np.ascontiguousarray(self.target.T), np.ones(len(self.bias), np.float32)
        for k in range(0, len(output), _SCORED):
            logits = self.predict(before[k:k + _SCORED], tables) @ weights
            logits += self.bias
            top = logits.max()
            shift = top if top - logits.min() < 80 else logits.max(axis=1, keepdims=True)  # exp() must not lose a whole row
            logits -= shift
            own = logits[np.arange(len(logits)), output[k:k + _SCORED]].astype(float)
            np.exp(logits, out=logits)
            out[k:k + _SCORED] = (own - np.log((logits @ ones).astype(float))) / np.log(10)
        return out


def initial(share: np.ndarray, seed: int = 11) -> LogBilinear:
    """Small random vectors; the bias is the log share of each output."""
    rng = np.random.default_rng(seed)
    small = lambda *n: rng.normal(0, 0.1, n).astype(np.float32)
    place = np.stack([np.eye(DIMENSION) / (1 + k) for k in range(CONTEXT)]).astype(np.float32) + small(CONTEXT, DIMENSION, DIMENSION) / 10
    return LogBilinear(small(len(share), DIMENSION), place, small(len(share), DIMENSION), np.log(share).astype(np.float32))


def windows(padded: np.ndarray) -> np.ndarray:
    """The CONTEXT outputs before each token, nearest first, of outputs that
    CONTEXT others precede."""
    return np.stack([padded[CONTEXT - 1 - i:len(padded) - 1 - i] for i in range(CONTEXT)], axis=1)


class Learner:
    """Adagrad steps of noise-contrastive estimation."""

    def __init__(self, model: LogBilinear, share: np.ndarray, seed: int):
        self.m, self.log_noise = model, np.log(NOISE * share).astype(np.float32)
        self.cumulative = np.cumsum(share) / share.sum()
        self.rng = np.random.default_rng(seed)
        self.seen = [np.full(x.shape, 1e-2, np.float32) for x in (model.context, model.place, model.target, model.bias)]

    def _apply(self, k: int, value: np.ndarray, gradient: np.ndarray) -> None:
        self.seen[k] += gradient * gradient
        value += RATE * gradient / np.sqrt(self.seen[k])

    def step(self, before: np.ndarray, output: np.ndarray) -> None:
        m, size = self.m, len(output)
        tables = np.einsum("vd,cde->cve", m.context, m.place)
        h = m.predict(before, tables)
        noise = np.searchsorted(self.cumulative, self.rng.random(NOISE)).clip(0, len(m.bias) - 1)
        own = (h * m.target[output]).sum(1) + m.bias[output] - self.log_noise[output]
        other = h @ m.target[noise].T + (m.bias[noise] - self.log_noise[noise])
        up = (1 - sigmoid(own)).astype(np.float32) / size
        down = -sigmoid(other).astype(np.float32) / size
        dh = up[:, None] * m.target[output] + down @ m.target[noise]
        n, d = len(m.bias), DIMENSION
        scatter = lambda at, rows: np.stack([np.bincount(at, rows[:, j], n) for j in range(d)], axis=1).astype(np.float32)
        target = scatter(output, up[:, None] * h)
        np.add.at(target, noise, down.T @ h)
        bias = np.bincount(output, up, n) + np.bincount(noise, down.sum(0), n)
        hit = [scatter(before[:, i], dh) for i in range(CONTEXT)]
        place = np.stack([m.context.T @ x for x in hit])
        context = sum(x @ m.place[i].T for i, x in enumerate(hit))
        for k, (value, gradient) in enumerate(((m.context, context), (m.place, place), (m.target, target), (m.bias, bias.astype(np.float32)))):
            self._apply(k, value, gradient)


def _pack(unit: int) -> Callable:
    """From pieces, sorted by shard, to a row per shard; one that repeated rows
    make longer than ``unit`` tokens goes on in a further row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size = None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([held], pa.list_(pa.binary()))], ["shard", "pieces"])
        for batch in batches:
            for of, piece in zip(batch.column("shard").to_pylist(), batch.column("o").to_pylist(), strict=True):
                if held and (of != shard or size >= unit):
                    yield out()
                    held, size = [], 0
                shard = of
                held.append(piece)
                size += len(piece) // 2 - CONTEXT
        if held:
            yield out()
    return run


def shards(encoded: DataFrame, total: int) -> DataFrame:
    """(shard, pieces) of the training texts, written; ``total`` is the number
    of their tokens."""
    number = max(1, -(-2 * total // UNIT))
    tasks = min(number, int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces = encoded.where(~F.col("held_out")).select("h", "o", F.explode(F.sequence(F.lit(0), F.expr(f"cast((n_tokens - 1) div {PIECE} as int)"))).alias("k"))
    pieces = pieces.select(F.pmod(F.xxhash64("h", "k"), F.lit(number).cast("bigint")).alias("shard"), "h", "k",
                           F.expr(f"substring(o, 1 + 2 * {PIECE} * k, 2 * {PIECE + CONTEXT})").alias("o"))
    dealt = pieces.repartition(tasks, "shard").sortWithinPartitions("shard", "h", "k")
    return materialize(dealt.select("shard", "o").mapInArrow(_pack(UNIT), "shard bigint, pieces array<binary>"), "lm-shards")


def _train(model: LogBilinear, share: np.ndarray, turn: int) -> Callable:
    """The models of a task's shards after their positions of this round,
    summed, as rows (k, value, n): the kth parameter in steps of 1 / _UNITS,
    times the positions learnt from, and those."""
    def learn(pieces: list[bytes]) -> tuple[np.ndarray, int]:
        learner = Learner(model.like(model.flat().copy()), share, 1000 + turn)
        padded = [np.frombuffer(p, "<i2").astype(np.int64) for p in pieces]
        before = np.concatenate([windows(p)[turn::ROUNDS] for p in padded])
        after = np.concatenate([p[CONTEXT + turn::ROUNDS] for p in padded])
        for k in range(0, len(after), BATCH):
            learner.step(before[k:k + BATCH], after[k:k + BATCH])
        return np.rint(learner.m.flat().astype(float) * _UNITS).astype(np.int64), len(after)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, held = 0, 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), n))], ["k", "value", "n"])
        for batch in batches:
            for pieces in batch.column("pieces"):
                flat, positions = learn(pieces.as_py())
                total, n, held = total + flat * positions, n + positions, held + 1
                if held == 256:  # the sums fit 64 bits
                    yield out()
                    total, n, held = 0, 0, 0
        if held:
            yield out()
    return run


def learn(units: DataFrame, model: LogBilinear, share: np.ndarray) -> LogBilinear:
    for turn in range(ROUNDS):
        rows = units.select("pieces").mapInArrow(_train(model, share, turn), "k int, value bigint, n bigint")
        whole = rows.groupBy("k").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("string").alias("value"), F.sum("n").alias("n"))
        mean = whole.toPandas().sort_values("k")
        if mean["n"].sum():
            model = model.like(np.array([int(v) / (_UNITS * int(n)) for v, n in zip(mean["value"], mean["n"], strict=True)]))
    return model


@dataclass
class Trained:
    tokens: Tokens
    model: LogBilinear
    group_log: np.ndarray  # log10 of the counts, types and one in each group
    total: int  # training tokens
    kinds: int  # distinct ones
    counts: DataFrame
    encoded: DataFrame  # the documents that it was learnt from, and those held out


def train(docs: DataFrame, mod: int = 7, held_out: int = 2) -> Trained:
    """Counts and model from the texts outside the held-out fold."""
    texts = docs.where(fold(F.col("doc_id"), mod) != held_out).select(whole_text().alias("text"))
    counts = count_tokens(texts)
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # How many words are frequent follows from a histogram of counts (eight steps an octave).
    step = F.floor(8 * F.log2("c")).cast("int")
    steps, few, least = counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect(), 0, 1 << 30
    for s, n in sorted(steps, reverse=True):
        few += n
        if few > COMMON:
            break
        least = s
    common = counts.where(step >= least).toPandas().sort_values(["c", "word"], ascending=[False, True])
    words, c = [w.encode() for w in common["word"]], common["c"].to_numpy(np.int64)
    forms = common["form"].to_numpy(np.int64)
    # The end token is an output of its own, whatever its rank.
    end = words.index(b"") if b"" in words else -1
    short = min(SHORT, len(words))
    output = np.where(np.arange(len(words)) < short, np.arange(len(words)), short + forms)
    if end >= short:
        output[short - 1], output[end] = short + forms[short - 1], short - 1
    tokens = Tokens({w: k for k, w in enumerate(words) if w}, output, np.log10(c + 1.0), end, short)
    groups = np.zeros((GROUPS, 2))
    for g, n, v in counts.where("form >= 0").groupBy("form").agg(F.sum("c"), F.count(F.lit(1))).collect():
        groups[g] = n, v
    single = output < short
    np.subtract.at(groups, forms[single & (forms >= 0)], np.stack([c[single & (forms >= 0)], np.ones(int((single & (forms >= 0)).sum()))], axis=1))
    weight = np.concatenate([np.bincount(output[single], c[single], short), groups[:, 0]]) + 1.0
    share = weight / weight.sum()
    group_log = np.log10(groups.sum(1) + 1)
    encoded = encode(docs, tokens, group_log, mod, held_out)
    model = initial(share)
    if total:
        model = learn(shards(encoded, int(total)), model, share)
    return Trained(tokens, model, group_log, int(total), int(kinds), counts, encoded)


def _encoder(tokens: Tokens, group_log: np.ndarray) -> Callable:
    def make():
        end_log = float(tokens.log_count[tokens.end]) if tokens.end >= 0 else 0.0

        def apply(batch: pa.Array) -> pa.Array:
            found: dict[str, list] = {k: [] for k in ("n_tokens", "common", "grouped", "n_common", "word", "n", "o")} | {"ends": [0]}
            for text in text_bytes(batch):
                words = words_of(text)
                ids = tokens.ids(words)
                o, rare = tokens.outputs(ids, words)
                logs = np.where(ids >= 0, tokens.log_count[ids], 0.0) if len(tokens.log_count) else np.zeros(len(ids))
                in_group = o >= tokens.short
                counted = Counter(rare)
                found["n_tokens"].append(len(words) + 1)
                found["common"].append(float(logs.sum()) + end_log)
                found["grouped"].append(float(logs[in_group].sum()) - float(group_log[o[in_group] - tokens.short].sum()))
                found["n_common"].append(len(words) - len(rare) + (tokens.end >= 0))
                found["ends"].append(found["ends"][-1] + len(counted))
                found["word"] += counted
                found["n"] += counted.values()
                padded = np.full(len(o) + CONTEXT + 1, tokens.end_output, "<i2")
                padded[CONTEXT:-1] = o
                found["o"].append(padded.tobytes())
            pairs = pa.StructArray.from_arrays([pa.array(found["word"], pa.binary()).cast(pa.string()), pa.array(found["n"], pa.int64())], ["word", "n"])
            numbers = [pa.array(found[k], kind) for k, kind in (("n_tokens", pa.int64()), ("common", pa.float64()), ("grouped", pa.float64()), ("n_common", pa.int64()))]
            return pa.StructArray.from_arrays([*numbers, pa.ListArray.from_arrays(pa.array(found["ends"], pa.int32()), pairs), pa.array(found["o"], pa.binary())],
                                              ["n_tokens", "common", "grouped", "n_common", "rare", "o"])
        return apply
    return make


_PARTS = "struct<n_tokens:bigint,common:double,grouped:double,n_common:bigint,rare:array<struct<word:string,n:bigint>>,o:binary>"


def encode(docs: DataFrame, tokens: Tokens, group_log: np.ndarray, mod: int = 7, held_out: int = 2) -> DataFrame:
    """Per row, written: its fold, h (a hash of id and text), the sums of log
    counts of its ranked words, its rare words, and o: its outputs as
    little-endian 16-bit integers, after CONTEXT end tokens."""
    parts = column_function(_encoder(tokens, group_log), _PARTS)(whole_text())
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), (fold(F.col("doc_id"), mod) == held_out).alias("held_out"),
                       F.xxhash64("doc_id", whole_text()).alias("h"), parts.alias("p"))
    return materialize(rows.select("row", "id", "held_out", "h", "p.*"), "lm-encoded")


def _scorer(model: LogBilinear) -> Callable:
    def make():
        def apply(batch: pa.Array) -> pa.Array:
            out, group, size = [], [], 0

            def flush() -> None:
                logs = model.log10(np.concatenate([windows(p) for p in group]), np.concatenate([p[CONTEXT:] for p in group]))
                starts = np.cumsum([0, *(len(p) - CONTEXT for p in group[:-1])])
                out.extend(np.add.reduceat(logs, starts).tolist())
            for o in batch.cast(pa.binary()):
                group.append(np.frombuffer(o.as_py(), "<i2").astype(np.int64))
                size += len(group[-1])
                if size > 1 << 17:
                    flush()
                    group, size = [], 0
            if group:
                flush()
            return pa.array(out, pa.float64())
        return apply
    return make


def score(encoded: DataFrame, t: Trained) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per
    row of what ``encode`` wrote."""
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    found = rare.join(t.counts.select("word", "c"), "word").groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_log"), F.sum("n").alias("n_rare"))
    scored = encoded.select("row", "id", "held_out", "n_tokens", "common", "grouped", "n_common", column_function(_scorer(t.model), "double")(F.col("o")).alias("lm"))
    joined = scored.join(found, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return joined.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
                         F.lit(t.total).cast("bigint").alias("train_tokens"),
                         (F.col("common") + rare_log - F.col("n_tokens") * F.lit(float(np.log10(t.total + t.kinds + 1)))).alias("base_score"),
                         (F.col("lm") + F.col("grouped") + rare_log).alias("score"))


def token_scores(docs: DataFrame, mod: int = 7, held_out: int = 2) -> DataFrame:
    """The scores of all texts, learnt from those outside the held-out fold."""
    t = train(docs, mod, held_out)
    return score(t.encoded, t)
