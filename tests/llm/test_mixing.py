"""Rates against numpy's projected gradient in document space; posteriors against plain Bayes."""
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import mixing
from airshed.llm.common import table
from airshed.session import materialize


def test_posteriors_equal_plain_bayes(spark, tables):
    docs, labels = table(spark, tables, "documents"), table(spark, tables, "labels")
    domains = list(mixing.TARGETS)
    sample = mixing.domain_sample(labels, mixing.label_domain(), domains)
    found, prior = mixing.fit_terms(docs, sample, domains)
    buckets = {r.bucket: r for r in found.collect()}
    got = {r.doc_id: r for r in mixing.posteriors(docs, found, prior, domains).collect()}
    terms = mixing._terms().alias("t")
    for r in docs.select("doc_id", F.transform(terms, lambda x: F.when(x != "", F.pmod(F.xxhash64(x), F.lit(mixing.BUCKETS)))).alias("b")).limit(40).collect():
        mine = [b for b in r.b if b is not None]
        n = len(mine)
        logs = [p + min(1.0, mixing.EVIDENCE / max(1, n)) * (sum(buckets[b][f"l{k}"] for b in mine) if k else 0) for k, p in enumerate(prior)]
        want = np.exp([x - max(logs) for x in logs])
        assert got[r.doc_id].tokens == n
        assert np.allclose([got[r.doc_id][f"p{k}"] for k in range(len(domains))], want / want.sum(), atol=1e-9)
    counts = Counter(x.domain for x in sample.collect())
    assert math.isclose(math.exp(prior[0]), (counts[domains[0]] + 1) / (sum(counts.values()) + len(domains)))


def test_prior_counts_the_labelled_rows_present(spark, as_docs):
    labels = spark.createDataFrame([(k, int(k < 6), 0) for k in range(20)], "doc_id long, quality int, toxic int")
    docs = as_docs([(k, f"word{k} and more") for k in (0, 0, 1, 2, 3, 10)])  # most rejects are gone
    domains = list(mixing.TARGETS)
    prior = mixing.fit_terms(docs, mixing.domain_sample(labels, mixing.label_domain(), domains), domains)[1]
    assert np.allclose(np.exp(prior), np.array([5, 1, 2, 1]) / 9)


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3] * 3, 400)
    tokens = rng.integers(1, 500, 400)
    frame = spark.createDataFrame([(int(n), *map(float, x)) for n, x in zip(tokens, p, strict=True)], "tokens long, p0 double, p1 double, p2 double")
    members = materialize(frame, "test-members")
    rated = mixing.fit_rates(members, [0.6, 0.3, 0.1], 1.25, rounds=60).collect()
    got = np.array([r.rate for r in rated])
    rows = np.array([(r.tokens, r.p0, r.p1, r.p2) for r in rated])
    assert (got >= 0).all()
    assert np.allclose((got * rows[:, 0]) @ rows[:, 1:], 1.25 * tokens.sum() * np.array([0.6, 0.3, 0.1]), rtol=2e-3)


def test_default_fit_reaches_the_production_targets(spark):
    # Soft posteriors over rare domains: plain gradient steps need thousands of rounds here.
    rng = np.random.default_rng(5)
    p = 0.9 * rng.dirichlet([8, 0.3, 0.3, 0.1], 3000) + 0.1 * np.array([0.9, 0.06, 0.03, 0.01])
    tokens = rng.integers(1, 500, 3000)
    frame = spark.createDataFrame([(int(n), *map(float, x)) for n, x in zip(tokens, p, strict=True)], "tokens long, p0 double, p1 double, p2 double, p3 double")
    members = materialize(frame, "test-members")
    shares = np.array(list(mixing.TARGETS.values()))
    rated = mixing.fit_rates(members, list(shares), mixing.BUDGET)
    rows = np.array([(r.tokens, r.p0, r.p1, r.p2, r.p3, r.rate) for r in rated.collect()])
    assert (rows[:, 5] >= 0).all()
    assert np.allclose((rows[:, 5] * rows[:, 0]) @ rows[:, 1:5], mixing.BUDGET * tokens.sum() * shares, rtol=2e-3)
    fit = mixing.solve_rates(members, list(shares), mixing.BUDGET)
    assert fit.converged and fit.residual < 1e-3 and np.allclose(fit.reached, 1, atol=1e-3)


def numpy_fit(tokens, p, target, weigh, rounds=20_000):
    """Plain projected gradient over all documents' rates, from 1."""
    total, r = tokens.sum(), np.ones(len(tokens))
    steep = np.linalg.eigvalsh((p * weigh).T @ (p * weigh * tokens[:, None]) / total).max()
    for _ in range(rounds):
        r = np.maximum(0, r - p @ (weigh ** 2 * ((r * tokens) @ p / total - target)) / steep)
    return r, ((((r * tokens) @ p / total - target) * weigh) ** 2).sum()


@pytest.mark.parametrize("weights", [[0.34, 0.33, 0.33], [0.45, 0.35, 0.2], [0.97, 0.02, 0.01]])
def test_fit_is_as_good_as_numpys_projected_gradient(spark, weights, monkeypatch):
    monkeypatch.setattr(mixing, "REPEAT", 1e9)  # the bound on what a domain's steps lift is a matter of its own
    rng = np.random.default_rng(8)
    p, tokens = 0.7 * rng.dirichlet([0.5] * 3, 300) + 0.1, rng.integers(1, 300, 300)  # the last targets can't be met
    frame = spark.createDataFrame([(int(n), *map(float, x)) for n, x in zip(tokens, p, strict=True)], "tokens long, p0 double, p1 double, p2 double")
    fit = mixing.solve_rates(materialize(frame, "test-members"), weights, 1.25)
    target = 1.25 * np.array(weights)
    rates, loss = numpy_fit(tokens.astype(float), p, target, 1 / target)
    assert ((np.array(fit.reached) - 1) ** 2).sum() <= loss * 1.05 + 1e-6
    assert fit.converged == (loss < 1e-6) and min(r.rate for r in fit.members.collect()) >= 0


def test_rates_that_nothing_projects_are_the_nearest_to_one(spark):
    rng = np.random.default_rng(9)
    p, tokens = rng.dirichlet([3] * 3, 200), rng.integers(1, 300, 200)
    frame = spark.createDataFrame([(int(n), *map(float, x)) for n, x in zip(tokens, p, strict=True)], "tokens long, p0 double, p1 double, p2 double")
    rows = np.array([(r.tokens, r.p0, r.p1, r.p2, r.rate) for r in mixing.solve_rates(materialize(frame, "test-members"), [0.35, 0.33, 0.32], 1.1).members.collect()])
    t, q = rows[:, 0] / rows[:, 0].sum(), rows[:, 1:4]
    target = 1.1 * np.array([0.35, 0.33, 0.32])
    nearest = 1 - q @ np.linalg.solve((q * t[:, None]).T @ q, t @ q - target)
    assert (nearest > 0).all() and np.allclose(rows[:, 4], nearest, atol=2e-3)


def test_unreachable_targets_are_reported(spark):
    members = materialize(spark.createDataFrame([(100, 0.9, 0.1), (50, 0.8, 0.2)], "tokens long, p0 double, p1 double"), "test-members")
    with pytest.warns(UserWarning, match="targets"):
        mixing.fit_rates(members, [0.2, 0.8], 1.0)
    fit = mixing.solve_rates(members, [0.2, 0.8], 1.0)
    assert not fit.converged and fit.residual > 0.1


def test_a_scarce_domain_takes_no_others_place(spark):
    # Hardly anything of the second domain: its target is missed, the first one's isn't, and every document of that stays.
    rows = [(100, 1 - q, q) for q in np.random.default_rng(3).random(500) * 1e-3]
    members = materialize(spark.createDataFrame([(n, float(a), float(b)) for n, a, b in rows], "tokens long, p0 double, p1 double"), "test-members")
    fit = mixing.solve_rates(members, [0.98, 0.02], 1.25)
    assert not fit.converged and abs(fit.reached[0] - 1) < 1e-3 and fit.reached[1] < 0.1
    got = [r.rate for r in fit.members.collect()]
    assert min(got) > 1.2 and max(got) < 1.25


def test_cases(docs, none, spark, texts):
    labels = spark.createDataFrame([(10, 1, 0), (11, 0, 1), (11, 1, 0), (12, None, 1), (None, 1, 1), (13, 5, 5)], "doc_id long, quality int, toxic int")
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == len(texts) and all(r.rate >= 0 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)
    assert all(abs(sum(r[f"p_{d}"] for d in mixing.TARGETS) - 1) < 1e-9 for r in rows)
    out = mixing.resample(docs, labels)
    assert out.columns == docs.columns
    copies = Counter((r.doc_id, r.h) for r in rows for _ in range(r.copies))
    assert out.count() == sum(copies.values())
    assert mixing.mix(none, labels).collect() == [] and mixing.resample(none, labels).collect() == []
    assert mixing.mix(docs, labels.limit(0)).count() == len(texts)
