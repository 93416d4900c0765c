"""Base scores and counts against plain counting; probabilities sum to one."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from airshed.llm import logbilinear as lm
from airshed.llm.common import table


def words(text):
    return (text or "").encode().lower().split()


def plain(rows):
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = [*words(t), None]
        out.append((str(i), len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out


def test_base_scores(docs, none, texts):
    got = lm.token_scores(docs).collect()
    key = lambda x: (x[0], x[1], round(x[-1], 6))
    have = sorted([(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    for a, b in zip(have, sorted(plain(texts), key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.token_scores(none).collect() == []


def test_beats_the_base_on_held_out_text_whatever_the_partitions(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    one = {r.doc_id: r for r in lm.token_scores(docs.coalesce(1)).collect()}
    many = {r.doc_id: r for r in lm.token_scores(docs.repartition(16)).collect()}
    for rows in (one, many):
        held = [r for r in rows.values() if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)
    assert all(abs(one[i].score - many[i].score) < 1e-6 * one[i].n_tokens for i in one) and len(one) == len(many)


def test_long_texts_in_pieces_and_shards(spark, as_docs, monkeypatch):
    """Pieces hold every training position once, with its context."""
    monkeypatch.setattr(lm, "PIECE", 5)
    monkeypatch.setattr(lm, "UNIT", 64)
    rows = [(k, " ".join(f"w{(k * j) % 23}" for j in range(4 + 9 * k))) for k in range(12)] + [(3, "same words here")] * 40
    t = lm.train(as_docs(rows))
    of = lambda o: np.frombuffer(o, "<i2")
    want = Counter()
    for r in t.encoded.where("not held_out").collect():
        o = of(r.o)
        want.update(tuple(o[k:k + lm.CONTEXT + 1].tolist()) for k in range(r.n_tokens))
    have, units = Counter(), lm.shards(t.encoded, t.total).collect()
    for u in units:
        assert sum(len(p) // 2 - lm.CONTEXT for p in u.pieces) < 64 + 5
        for p in map(of, u.pieces):
            have.update(tuple(p[k:k + lm.CONTEXT + 1].tolist()) for k in range(len(p) - lm.CONTEXT))
    assert have == want and len(units) > 3


def test_rare_words_by_join_equal_words_by_table(spark, docs, monkeypatch):
    whole = sorted((str(r.doc_id), r.n_known, round(r.base_score, 6)) for r in lm.token_scores(docs).collect())
    monkeypatch.setattr(lm, "COMMON", 400)
    assert sorted((str(r.doc_id), r.n_known, round(r.base_score, 6)) for r in lm.token_scores(docs).collect()) == whole


def test_probabilities_sum_to_one(docs):
    t = lm.train(docs)
    n = len(t.model.bias)
    assert n == t.tokens.short + lm.GROUPS
    for before in np.random.default_rng(0).integers(0, n, (5, lm.CONTEXT)):
        logs = t.model.log10(np.tile(before, (n, 1)), np.arange(n))
        assert (10 ** logs).sum() == pytest.approx(1, abs=1e-4)
    # Within a group: the counted words' shares and one place for the unseen.
    of_group = Counter()
    for r in t.counts.where("form >= 0").collect():
        w = r.word.encode()
        if int(t.tokens.outputs(t.tokens.ids([w]), [w])[0][0]) >= t.tokens.short:
            of_group[r.form] += r.c + 1
    for g, c in of_group.items():
        assert (c + 1) / 10 ** t.group_log[g] == pytest.approx(1)


def test_tasks_learn_from_the_average(docs, monkeypatch):
    # A model must not see its own partition's texts alone.
    starts, train_task = [], lm._train
    monkeypatch.setattr(lm, "_train", lambda model, *rest: starts.append(model.flat()) or train_task(model, *rest))
    lm.train(docs)
    assert len(starts) >= 2 and not np.allclose(starts[0], starts[1])
    assert lm.NOISE >= 64


def test_gradient_raises_the_objective():
    rng = np.random.default_rng(0)
    share = np.full(40, 1 / 40)
    model = lm.initial(share)
    before = rng.integers(0, 40, (6000, lm.CONTEXT))
    after = (before[:, 0] + 1) % 40  # the next token follows from the last
    first = model.log10(before, after).mean()
    learner = lm.Learner(model, share, 1)
    for _ in range(30):
        for k in range(0, 6000, 500):
            learner.step(before[k:k + 500], after[k:k + 500])
    assert model.log10(before, after).mean() > first + 0.5
