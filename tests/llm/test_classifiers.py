"""Held-out accuracy of the classifiers, and the awkward cases."""
import random
import zlib

import numpy as np
import pytest

from airshed.llm import gam, toxicity
from airshed.llm.common import table


def auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    return (p[y == 1][:, None] > p[y == 0][None, :]).mean() + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).mean()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = gam.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    label = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(label[r.doc_id], r.score) for r in rows if r.held_out and label.get(r.doc_id) is not None]
    assert auc(*zip(*held)) > 0.97


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(gam.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000], rounds=10)
    assert (2, 5) in [tuple(sorted(p[:2])) for p in model.pairs]
    assert auc(y[3000:], model.score(x[3000:])) > 0.95


def test_lookup_tables_equal_a_sum_over_bins():
    rng = np.random.default_rng(1)
    x = rng.random((300, len(gam.FEATURES)))
    model = gam.fit(x, (x[:, 0] > 0.4).astype(float), rounds=5, pair_rounds=3)
    row = x[7]
    bins = [int(np.searchsorted(e, v, side="right")) for e, v in zip(model.edges, row, strict=True)]
    want = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True)) + sum(t[ci[bins[i]], cj[bins[j]]] for i, j, ci, cj, t in model.pairs)
    assert model.margin(row[None])[0] == pytest.approx(want)


def test_interactions_of_terms_are_learnt():
    """Two terms that mean something only together."""
    rng = random.Random(0)
    texts, y = [], []
    for _ in range(3000):
        words = {f"w{rng.randrange(40)}x" for _ in range(8)}
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join(words | ({"insult"} if a else set()) | ({"group"} if b else set())).encode())
        y.append(a and b)
    vocabulary = np.array(sorted({t for x in texts for t in toxicity._terms(x)}))
    look = toxicity._Lookup(vocabulary)
    ids, y = [look(t) for t in texts], np.array(y, float)
    model = toxicity.fit(np.concatenate(ids[:2000]), np.array([len(i) for i in ids[:2000]]), y[:2000], vocabulary)
    assert auc(y[2000:], [model.margin(i) for i in ids[2000:]]) > 0.995
    both = model.vectors[look(b"insult group")]
    linear = np.array([model.weights[look(w)].sum() for w in (b"insult", b"group")])
    assert both.shape[0] >= 2 and np.isfinite(linear).all()
    # The quick form of the pairs' sum equals the sum over pairs.
    v = model.vectors[ids[3]]
    pairs = sum(v[i] @ v[j] for i in range(len(v)) for j in range(i))
    assert model.margin(ids[3]) == pytest.approx(model.bias + model.weights[ids[3]].sum() + pairs)


def test_a_word_that_excuses_another_is_learnt(spark):
    """Label 1 for the insult unless "quoting" stands beside it."""
    rng = random.Random(4)
    rows = []
    for k in range(6000):
        words = [f"w{rng.randrange(300)}x" for _ in range(10)]
        insult, quoting = rng.random() < 0.3, rng.random() < 0.5
        words += ["moron"] * insult + ["quoting"] * quoting
        rng.shuffle(words)
        rows.append((k, " ".join(words), int(insult and not quoting), insult))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).where("held_out").collect()}
    held = [(r[2], got[r[0]]) for r in rows if r[0] in got and r[3]]
    assert auc(*zip(*held)) > 0.99
    assert np.mean([p for y, p in held if y]) > 0.9 and np.mean([p for y, p in held if not y]) < 0.1


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = toxicity.toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    label = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    held = [(label[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and label.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    assert auc([h[0] for h in held], [h[1] for h in held]) > 0.95
    flagged = [h[0] for h in held if h[2]]
    assert sum(flagged) > 0.95 * len(flagged) and sum(flagged) > 0.7 * sum(h[0] for h in held)


@pytest.mark.parametrize("scores", [gam.quality_scores, toxicity.toxicity_scores])
def test_cases(spark, docs, none, texts, scores):
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(10, 70)] + [(11, 0, 0), (None, 1, 1), (5, None, None), (4, 1, 1)], "doc_id long, quality int, toxic int")
    first = sorted(((str(r.doc_id), r.score) for r in scores(docs, some).collect()), key=str)
    assert len(first) == len(texts) and all(0 <= s <= 1 for _, s in first)
    assert first == sorted(((str(r.doc_id), r.score) for r in scores(docs.repartition(5), some).collect()), key=str)
    assert scores(none, some).collect() == []
    one_kind = scores(docs, some.where("quality = 1")).collect()
    assert len({r.score for r in one_kind}) == 1 and len(scores(docs, some.limit(0)).collect()) == len(texts)


def test_quality_filter_keeps_rows_whole(spark, docs):
    some = spark.createDataFrame([(i, 1, 0) for i in range(10, 70)], "doc_id long, quality int, toxic int")
    kept = gam.keep_quality(docs, some)
    assert kept.columns == docs.columns and kept.count() == docs.count()
