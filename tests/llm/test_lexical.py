"""Lexical search against brute force, with segments of a few documents."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, queries, k):
    docs = [(i, Counter(TERM.findall(t.translate(LOWER)))) for i, t in rows if t is not None]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c in docs:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,block,parts", [(4096, 50_000, 3), (3, 10, 5), (1, 1, 1)])
def test_against_brute_force(spark, as_docs, texts, monkeypatch, segment, block, parts):
    rng = random.Random(segment)
    monkeypatch.setattr(lexical, "BLOCK", block)
    rows = texts + [(300 + j, " ".join(rng.choice(["Ab", "ab", "x1", "é_y", "zz-top", "q"]) for _ in range(rng.choice([3, 3, 3, 8, 40])))) for j in range(60)]
    queries = [(0, "ab x1, zz! ta"), (1, "nothing-of-this 日本語"), (2, ""), (3, None), (4, "AB ab Ab one"), (4, "id no"), (None, "é y"), (5, rows[30][1])]
    queries += [(10 + j, rows[20 + j][1]) for j in range(6)]
    schema = "item_id long, text string, query int, score long, term string"
    asked = spark.createDataFrame([(*q, 1, 2, "t") for q in queries], schema)
    found = lexical.search(lexical.build_index(as_docs(rows).repartition(parts), segment), asked, k=5)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, queries, 5)


def test_terms_are_counted_once_a_pass(as_docs, texts, capsys):
    odd = texts + [(500 + j, t) for j, t in enumerate(["a", "-", "--a--b--", "\x00é\x7f日", "😀 x😀y", "9:A@Z[a`z{", " a", "\n\n-", "\n\na"])]
    found = lexical.counted(as_docs(odd))
    want = [(i, t, len(lexical.terms_of(t.encode()))) for i, t in odd if t is not None]
    assert Counter(map(tuple, found.collect())) == Counter(r for r in want if r[2])
    found.agg(F.sum("n")).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_index_holds_every_posting(as_docs, texts):
    index = lexical.build_index(as_docs(texts).repartition(3), segment=7)
    have = Counter()
    for r in index.segments.collect():
        at, places, all_tfs = 0, np.frombuffer(r["places"], lexical._PLACE).tolist(), np.frombuffer(r["tfs"], lexical._TF).tolist()
        for term, n in zip(r["terms"].decode().split("\n"), np.frombuffer(r["counts"], lexical._TF).tolist()):
            tfs = all_tfs[at:at + n]
            assert list(tfs) == sorted(tfs, reverse=True)
            have.update((r["ids"][p], term, tf) for p, tf in zip(places[at:at + n], tfs))
            at += n
        assert at == len(all_tfs) and len(r["ids"]) <= 7
    want = Counter((i, t, n) for i, text in texts if text for t, n in Counter(TERM.findall(text.translate(LOWER))).items())
    assert have == want


def test_bounds_prune_but_lose_nothing(spark, as_docs):
    """The visits that bounds save, counted, against the same results."""
    rng = random.Random(2)
    rows = [(j, " ".join(rng.choice("abcdefghij") * 3 for _ in range(3 + j % 40))) for j in range(400)] + [(900 + j, "needle " * (j + 1) + "hay") for j in range(12)]
    queries = [(1, "needle aaa")]
    index = lexical.build_index(as_docs(rows), segment=10)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    (items, block), = lexical._blocks(asked, index)
    assert sorted((tuple(r) for r in lexical.search(index, asked, 3).collect()), key=str) == brute(rows, queries, 3)
    kth = brute(rows, queries, 3)[-1][3]
    batches = index.segments.toArrow().to_batches()
    bounds = [lexical._Segment(block, r, b).bounds[0] for b in batches for r in range(b.num_rows)]
    assert 0 < sum(x >= kth for x in bounds) < len(bounds) / 3


def test_empty_tables(spark, none, as_docs):
    asked = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert lexical.search(lexical.build_index(none), asked).count() == 0
    assert lexical.search(lexical.build_index(as_docs([(1, "x")])), asked.where("false")).count() == 0
