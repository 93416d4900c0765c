"""The Jaccard join against all pairs."""
import random

import numpy as np
import pytest

from airshed.llm import jaccard


def words_of(text):
    lower = {c: c + 32 for c in range(65, 91)}
    return (text or "").translate(lower).encode().split()


def brute(rows, percent):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def family(rng, base, words, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = rng.choice(words)
    return " ".join(out)


def corpus(seed):
    """Near copies just over and under the threshold, chains, a large group
    around one text, and a passage that many unlike texts share."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, passage = [], [rng.choice(words) for _ in range(60)]
    for f in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([4, 12, 40, 90, 200, 700]))]
        for _ in range(rng.randint(2, 7)):
            rows.append(family(rng, base, words, rng.randint(0, max(1, len(base) // 45))))
        chain = base
        for _ in range(4):  # each near the one before it
            chain = family(rng, chain, words, max(1, len(base) // 70)).split()
            rows.append(" ".join(chain))
    star = [rng.choice(words) for _ in range(150)]
    rows += [" ".join(star)] + [family(rng, star, words, 2) for _ in range(120)]
    rows += [" ".join(passage + [rng.choice(words) for _ in range(rng.randint(5, 60))]) for _ in range(80)]
    rng.shuffle(rows)
    return [(1000 + k, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("seed,parts,percent", [(1, 3, 90), (2, 7, 80)])
def test_against_all_pairs(as_docs, texts, seed, parts, percent):
    rows = texts + corpus(seed)
    got = jaccard.similar_components(as_docs(rows).repartition(parts), percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, percent)


def test_prefixes_share_enough_tokens():
    """The rule that steps 2 and 5 rest on, for all l."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = rng.choice(10_000, n, replace=False)
        b = np.concatenate([a[int(rng.integers(0, 1 + n // 9)):], 20_000 + np.arange(int(rng.integers(0, 1 + n // 9)))])
        both, every = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if len(b) == 0 or 100 * both < 90 * every:
            continue
        a, b = np.sort(a), np.sort(b)
        ta, tb = jaccard.least_overlap(len(a), 90), jaccard.least_overlap(len(b), 90)
        for la in range(1, ta + 1):
            for lb in {1, min(la, tb), tb}:
                assert len(np.intersect1d(a[:len(a) - ta + la], b[:len(b) - tb + lb])) >= min(la, lb)
        assert jaccard._sieve_l(len(b), 90) >= jaccard._sieve_l(ta, 90)


def test_frequent_tokens_only_change_the_order(as_docs, monkeypatch):
    rows = corpus(4)[:150]
    want = brute(rows, 90)
    for heavy, bound in ((2, 500_000), (2, 0)):
        monkeypatch.setattr(jaccard, "HEAVY", heavy)
        monkeypatch.setattr(jaccard, "FREQUENT", bound)
        assert sorted(map(tuple, jaccard.similar_components(as_docs(rows)).collect()), key=str) == want


def test_empty_tables(none, as_docs):
    assert jaccard.similar_components(none).count() == 0
    assert [tuple(r) for r in jaccard.similar_components(as_docs([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]
