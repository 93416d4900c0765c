"""Mixing documents to target domain weights, with soft membership.

A naive Bayes classifier over hashed terms, fitted on the labelled table,
gives each document a posterior over domains. Nonnegative document rates r
are then fitted by least squares, so that the expected tokens of each domain,
sum of r * tokens * posterior, match the targets. The fit is a projected
gradient from r = 1, distances weighted by tokens: a round moves each rate
along its posteriors, r = max(0, r - posterior . step), where the step is the
domains' misses scaled by the curvature (domains x domains) of the rates above
zero, damped towards the plain gradient; of a few dampings, the best is taken. All of them cost one aggregation of a few numbers a round over the small
per-document table; the rates are an expression, written to a column every
WRITTEN rounds. A domain's steps together lift a rate by REPEAT - 1 at most: a domain of which
there is too little misses its target, rather than that a few documents take
the place of all others.

DataFrame functions only. The classifier learns from a bounded number of
labelled rows (SAMPLE_ROWS); its table has BUCKETS rows at most, so it is
broadcast. Terms are counted up to one row per document before the shuffle.

Cases: a null text counts as empty; texts without terms have the prior as
posterior and zero tokens; labels outside the domains are ignored; a domain
without labelled rows keeps a small prior; a domain that can't reach its target
ends short of it, with a warning, the others at theirs; repeated rows are documents of their own;
other columns aren't read, or are carried (resample).
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import whole_text
from airshed.session import materialize

SAMPLE_ROWS = 20_000
BUCKETS = 1 << 15
#: A text's evidence counts as this many terms at most, so that long texts stay soft.
EVIDENCE = 16
#: Production targets: shares of quality x toxic domains, and tokens over the input's.
TARGETS = {"q1t0": 0.94, "q1t1": 0.03, "q0t0": 0.02, "q0t1": 0.01}
BUDGET = 1.25
#: A document of one domain alone is repeated so often at most, however short that domain is of its target.
REPEAT = 8
#: Rounds after which the rates are written, so that their expression stays short.
WRITTEN = 8

#: Dampings of the steps that a round tries, in plain gradient steps: 1 always descends, the first is Gauss-Newton's.
DAMPING = (1e-9, 1e-4, 1e-2, 1e-1, 1.0)

#: Terms are what stands between these (ASCII other than letters and digits), lower-cased; an empty one is none.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def label_domain() -> Column:
    """The domain of a row of ``labels``: q<quality>t<toxic>."""
    return F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))


def _terms() -> Column:
    """At least one element, empty where there is no term."""
    return F.split(F.lower(whole_text()), _BETWEEN)


def _bucket(term: str) -> Column:
    return F.when(F.col(term) == "", F.lit(BUCKETS).cast("bigint")).otherwise(F.pmod(F.xxhash64(F.col(term)), F.lit(BUCKETS).cast("bigint")))


def domain_sample(labels: DataFrame, domain: Column, domains: list[str], bound: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``bound`` rows (doc_id, domain), taken by a hash of the id; of
    an id with several domains, the first in alphabet."""
    rows = labels.select("doc_id", domain.alias("domain")).where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    place = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30))
    n = max(1, rows.count())
    few = rows.where(place < int(min(1.0, 1.1 * bound / n) * (1 << 30)))
    return few.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id", F.lit("mix")), "doc_id").limit(bound)


def fit_terms(docs: DataFrame, sample: DataFrame, domains: list[str]) -> tuple[DataFrame, list[float]]:
    """The classifier: (bucket, l1..), a row per bucket, with the log
    likelihoods over those of the first domain; and log priors, from the
    sampled ids among ``docs``. Buckets without training terms, and the one
    for no term, have zeros."""
    labelled = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id").select("domain", F.explode(_terms()).alias("term"))
    counts = labelled.select("domain", _bucket("term").alias("bucket")).groupBy("bucket").agg(
        *[F.sum((F.col("domain") == d).cast("double")).alias(f"c{k}") for k, d in enumerate(domains)])
    counts = materialize(counts, "mix-terms")
    total = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0.0)) for k in range(len(domains))]).first()
    # Labelled rows that an earlier stage has removed don't count.
    rows = dict(docs.select("doc_id").join(F.broadcast(sample), "doc_id").distinct().groupBy("domain").count().collect())
    n = sum(rows.values())
    prior = [float(np.log((rows.get(d, 0) + 1) / (n + len(domains)))) for d in domains]
    log = [F.log((F.col(f"c{k}") + 1) / (total[k] + BUCKETS)) for k in range(len(domains))]
    seen = counts.where(F.col("bucket") < BUCKETS).select("bucket", *[(log[k] - log[0]).alias(f"l{k}") for k in range(1, len(domains))])
    every = docs.sparkSession.range(BUCKETS + 1).select(F.col("id").alias("bucket"))
    return every.join(seen, "bucket", "left").select("bucket", *[F.coalesce(f"l{k}", F.lit(0.0)).alias(f"l{k}") for k in range(1, len(domains))]), prior


def posteriors(docs: DataFrame, table: DataFrame, prior: list[float], domains: list[str]) -> DataFrame:
    """(doc_id, h, tokens, p0..) per document; h is a hash of the text."""
    k = range(1, len(domains))
    # What stands beside explode() in one select is evaluated per term, so the hash of the text comes first.
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(whole_text()).alias("h"), whole_text().alias("text"))
    exploded = numbered.select("row", "doc_id", "h", F.explode(_terms()).alias("term"))
    scored = exploded.select("row", "doc_id", "h", (F.col("term") != "").cast("long").alias("one"), _bucket("term").alias("bucket")).join(F.broadcast(table), "bucket")
    sums = scored.groupBy("row", "doc_id", "h").agg(F.sum("one").alias("tokens"), *[F.sum(f"l{i}").alias(f"l{i}") for i in k])
    scale = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest(F.col("tokens"), F.lit(1)))
    logs = [F.lit(prior[0]), *[F.lit(prior[i]) + scale * F.col(f"l{i}") for i in k]]
    sums = sums.select("doc_id", "h", "tokens", *[x.alias(f"l{i}") for i, x in enumerate(logs)])
    top = F.greatest(*[F.col(f"l{i}") for i in range(len(logs))]) if len(logs) > 1 else F.col("l0")
    sums = sums.select("doc_id", "h", "tokens", *[F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in range(len(logs))])
    whole = sum((F.col(f"e{i}") for i in range(len(logs))), F.lit(0.0))
    return sums.select("doc_id", "h", "tokens", *[(F.col(f"e{i}") / whole).alias(f"p{i}") for i in range(len(logs))])


@dataclass
class Rates:
    """A fit: ``members`` with the column ``rate``; ``reached`` the expected
    tokens of each domain over its target (over a floor where that is near
    zero); ``residual`` the largest miss, in targets; ``rounds`` the
    aggregations that it took."""
    members: DataFrame
    reached: list[float]
    residual: float
    rounds: int
    converged: bool


def _moved(rate: Column, step: np.ndarray) -> Column:
    """Rates after a step along the posteriors, projected on rates >= 0."""
    return F.greatest(F.lit(0.0), rate - sum((F.col(f"p{i}") * F.lit(float(v)) for i, v in enumerate(step)), F.lit(0.0)))


def _sums(members: DataFrame, rates: list[Column], domains: int, total: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of the rates: the expected tokens of the domains and the
    curvature of the rates above zero, over all tokens; one aggregation."""
    k = range(domains)
    pairs = [(i, j) for i in k for j in range(i, domains)]
    tokens = F.col("tokens").cast("double")
    placed = members.select(tokens.alias("t"), *[F.col(f"p{i}") for i in k], *[r.alias(f"r{c}") for c, r in enumerate(rates)])
    numbers = []
    for c in range(len(rates)):
        kept = F.when(F.col(f"r{c}") > 0, F.col("t")).otherwise(F.lit(0.0))
        numbers += [F.sum(F.col(f"r{c}") * F.col("t") * F.col(f"p{i}")).alias(f"g{c}_{i}") for i in k]
        numbers += [F.sum(kept * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"s{c}_{i}_{j}") for i, j in pairs]
    values = np.array(placed.agg(*numbers).first(), float).reshape(len(rates), -1) / total
    out = []
    for row in values:
        curve = np.zeros((domains, domains))
        for (i, j), v in zip(pairs, row[domains:], strict=True):
            curve[i, j] = curve[j, i] = v
        out.append((row[:domains], curve))
    return out


def solve_rates(members: DataFrame, weights: list[float], budget: float, rounds: int = 60, tolerance: float = 1e-3) -> Rates:
    """Rates that reach the targets to ``tolerance``, from 1 on; ``members``
    is a written table, ``weights`` are shares of ``budget`` times all tokens,
    by domain. ``rounds`` is a bound against endless fits only: one that meets
    it, like one whose targets no rates reach (it ends near the least squares), isn't silent."""
    n = len(weights)
    total = float(members.agg(F.coalesce(F.sum(F.col("tokens").cast("double")), F.lit(0.0))).first()[0])
    members, rate = members.withColumn("rate", F.lit(1.0)), F.col("rate")
    if not total:
        return Rates(members, [], 0.0, 0, True)
    target = np.array(weights, float) / sum(weights) * budget
    weigh = 1 / np.maximum(target, 0.01 / n)  # a target near zero must not rule the fit
    slow, moved, limit = 0, np.zeros(n), REPEAT - 1.0  # what the steps have lifted each domain by; its bound
    (got, curve), used = _sums(members, [rate], n, total)[0], 1
    steep = max(1e-15, float(weigh ** 2 @ np.diag(curve)))  # at least the largest eigenvalue, for every set of rates
    while used < rounds:
        over = got - target
        free = (moved < limit) | (over > 0)  # a domain at its bound can only fall
        worth = ((over * weigh)[free] ** 2).sum()
        if np.abs((over * weigh)[free]).max(initial=0) < tolerance / 5:
            break
        inner, steps = curve[np.ix_(free, free)], []
        for damp in DAMPING:
            step = np.zeros(n)
            step[free] = np.linalg.solve(inner + np.diag(damp * steep / weigh[free] ** 2), over[free])
            # A domain that meets its bound on the way shortens the step; at its bound it stands still.
            step[(step < 0) & (moved >= limit)] = 0.0
            room = [(limit - moved[i]) / -step[i] for i in range(n) if step[i] < 0]
            steps.append(step * min([1.0, *room]))
        found = _sums(members, [_moved(rate, s) for s in steps], n, total)
        used += 1
        losses = [(((g - target) * weigh)[free] ** 2).sum() for g, _ in found]
        best = int(np.argmin(losses))
        met = (moved - steps[best] >= limit - 1e-9) & (moved < limit - 1e-9)
        slow = 0 if losses[best] < worth * (1 - 1e-3) or met.any() else slow + 1
        if slow == 5 or (losses[best] >= worth and not met.any()):
            break
        rate, moved = _moved(rate, steps[best]), np.minimum(limit, moved - steps[best])
        moved[moved >= limit - 1e-9] = limit
        got, curve = found[best]
        if used % WRITTEN == 0:
            kept = [F.col(f"`{c}`") for c in members.columns if c != "rate"]
            members, rate = materialize(members.select(*kept, rate.alias("rate")), "mix-rates"), F.col("rate")
    miss = float(np.abs((got - target) * weigh).max())
    return Rates(members.withColumn("rate", rate), (got * weigh).tolist(), miss, used, miss < tolerance)


def fit_rates(members: DataFrame, weights: list[float], budget: float, rounds: int = 60, tolerance: float = 1e-3) -> DataFrame:
    """``members`` with the column ``rate``, and a warning of missed targets."""
    fit = solve_rates(members, weights, budget, rounds, tolerance)
    if not fit.converged:
        warnings.warn(f"mixture: after {fit.rounds} rounds the expected tokens are {[round(x, 4) for x in fit.reached]} of their targets", stacklevel=2)
    return fit.members


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET, domain: Column | None = None,
        bound: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, tokens, p_<domain>, rate, and copies: the rate
    rounded up or down by a hash of the id, so that copies are whole and
    right on average. h is a hash of the text."""
    targets = TARGETS if targets is None else targets
    domains = list(targets)
    sample = domain_sample(labels, label_domain() if domain is None else domain, domains, bound)
    members = materialize(posteriors(docs, *fit_terms(docs, sample, domains), domains), "mix-members")
    members = fit_rates(members, list(targets.values()), budget)
    u = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = members.select("doc_id", "h", "tokens", *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)], "rate")
    return rated.withColumn("copies", F.floor(F.col("rate") + u).cast("int"))


def resample(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET) -> DataFrame:
    """``docs`` with each row as often as its copies say, all columns."""
    # Rows that repeat an id and text have the same copies.
    rates = mix(docs, labels, targets, budget).where("copies > 0").groupBy(F.col("doc_id").alias("__mix_id"), F.col("h").alias("__mix_h")).agg(F.max("copies").alias("__mix_copies"))
    joined = docs.join(rates, F.col("doc_id").eqNullSafe(F.col("__mix_id")) & (F.xxhash64(whole_text()) == F.col("__mix_h")))
    often = F.explode(F.array_repeat(F.lit(1), F.col("__mix_copies"))).alias("__mix_copy")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], often).drop("__mix_copy")
