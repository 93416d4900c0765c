"""Native operators against plain Python."""
import re
from collections import Counter

import pytest

from airshed.llm import cascade, snapshots

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    many = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if many[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures(docs, none, texts):
    got = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed) for r in cascade.judged(docs).collect())
    assert [g[0] for g in got] == sorted((str(i), *plain(t)) for i, t in texts)
    assert all(failed == (g[1] < 50 or 100 * g[5] > 50 * g[1]) for g, failed in got)
    assert cascade.judged(none).collect() == []


def test_verdict_does_not_depend_on_the_order(docs):
    rules = cascade.production_rules()
    one = cascade.measures(docs).select("doc_id", cascade.verdict(rules).isNull().alias("kept"))
    other = cascade.measures(docs).select("doc_id", cascade.verdict(rules[::-1]).isNull().alias("kept"))
    assert Counter(one.collect()) == Counter(other.collect())


def test_rules_come_by_rejection_per_work(docs):
    order = cascade.order_rules(docs, cascade.production_rules())
    worth = [share / work for _, share, work in order]
    assert worth == sorted(worth, reverse=True) and worth[0] > 0


def test_the_order_saves_work(spark, as_docs, none):
    """Half of the texts fail a rule on ready measures, a tenth a dear one."""
    clean = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80))
    docs = as_docs([(k, "short text" if k % 2 else "- " + clean.replace(" ", "\n- ") if k % 10 == 0 else clean) for k in range(400)])
    rules = cascade.production_rules()
    order = cascade.order_rules(docs, rules)
    assert order[0][0].name == "too_short" and {r.name for r, _, _ in order[-5:]} >= {"no_letters", "ellipses"}
    work = {r.name: w for r, _, w in order}
    assert work["too_short"] == 1 and work["no_letters"] > work["capitals"] > 50
    assert [r.name for r, share, _ in order if share > 0] == ["too_short", "bullets"]
    ordered, turned = cascade.mean_work(docs, [r for r, _, _ in order]), cascade.mean_work(docs, rules[::-1])
    assert ordered < 0.95 * turned
    assert cascade.mean_work(none, rules) == 0.0


WORDS60 = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]


@pytest.mark.parametrize("name, text", [
    ("capitals", " ".join(WORDS60).upper()), ("digits", " ".join(f"w{k}93571" for k in range(60))), ("bullets", "\n".join(f" - {w}" for w in WORDS60)),
    ("ellipses", "\n".join(f"{w} goes on... " for w in WORDS60)), ("ellipses", "\n".join(f"{w} on…" for w in WORDS60)),
    ("no_letters", " ".join([f"{w}abcdef" for w in WORDS60[:25]] + ["+" * (k % 9 + 1) + "-=!" * (k // 9) for k in range(35)])),
    (None, " ".join(WORDS60)), (None, "\n".join(f"- {w}" for w in WORDS60[:54]) + "\n" + "\n".join(WORDS60[54:])), (None, " ".join(f"é{w}" for w in WORDS60))])
def test_rules_that_read_the_text(as_docs, name, text):
    [row] = cascade.apply(as_docs([(1, text)])).collect()
    assert row.failed_rule == name


def test_filter_on_the_verdict_and_clashing_columns(docs):
    out = cascade.apply(docs)
    assert set(docs.columns) <= set(out.columns)
    kept = out.where("failed_rule is null").count()
    assert kept == sum(r.failed_rule is None for r in out.collect())


def maximal(rows):
    """conv_id -> list of (role, text) of the maximal conversations."""
    convs = {}
    for c, turn, role, text in {r for r in rows if r[0] is not None}:
        convs.setdefault(c, set()).add((turn is not None, turn or 0, role or "", text or ""))
    whole = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}
    out = {}
    for c, x in whole.items():
        longer = any(len(y) > len(x) and y[:len(x)] == x for y in whole.values())
        if not longer and c == min(k for k, y in whole.items() if y == x):
            out[c] = x
    return out


CHATS = ([(1, k, r, t) for k, (r, t) in enumerate([("user", "a"), ("bot", "b")])] + [(2, k, r, t) for k, (r, t) in enumerate([("user", "a"), ("bot", "b"), ("user", "c")])]
         + [(3, k, r, t) for k, (r, t) in enumerate([("user", "a"), ("bot", "B")])] + [(4, 5, "user", "a"), (4, 9, "bot", "b"), (5, 0, "user", "a"), (5, 0, "user", "a")]
         + [(6, None, None, None), (6, 1, "bot", None), (7, 0, "user", "x"), (7, 0, "user", "y"), (None, 0, "user", "a"), (8, 3, "", "")]
         + [(9, k, "user", f"m{k}") for k in range(50)] + [(10, k, "user", f"m{k}") for k in range(37)] + [(11, 2 * k, "user", f"m{k}") for k in range(50)])


@pytest.mark.parametrize("part", [7, 1024])
def test_maximal_conversations(spark, part):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in CHATS], "conv_id long, turn long, role string, text string, pos int, a int, part int").repartition(3)
    got = {}
    for r in sorted(snapshots.format_chats(frame, part).collect(), key=lambda r: (r.conv_id, r.part)):
        got.setdefault(r.conv_id, [0, ""])
        assert r.part == got[r.conv_id][0]
        got[r.conv_id] = [r.part + 1, got[r.conv_id][1] + r.text]
    want = maximal(CHATS)
    assert {c: x[1] for c, x in got.items()} == {c: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in x) for c, x in want.items()}
    assert snapshots.format_chats(frame.limit(0)).collect() == []
