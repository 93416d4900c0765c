"""Base spans against the plain patterns; learning on a planted context."""
import hashlib
import random
import re

from airshed.llm import pii

PLAIN = [(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), (1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         (2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    d = [int(c) for c in d]
    return (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text):
            d = "".join(c for c in m[0] if c in "0123456789")
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")) or kind == 2 and not (14 <= len(d) <= 19 and luhn(d)) or kind == 3 and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    parts = ["a", "b.c", "@", "x@y.z", ".", "1", "25", "255", "256", "1.2.3.4", "+", "+1 ", "(437) ", "555-0199", " ", "-", "4111111111111111", "é", "%", "\n", "0001", "_"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 24)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+" * 100_000, "@" * 100_000, "a@" * 100_000, "+1 " * 60_000, "1 " * 100_000):
        pii.base_spans(text)
        pii._candidates(text, [])


def digest(text):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain(text or ""))


def test_documents(docs, none, texts):
    rows = pii.digest(docs).collect()
    assert sorted((str(r.doc_id), r.base_sha256) for r in rows) == sorted((str(i), hashlib.sha256(digest(t).encode()).hexdigest()) for i, t in texts)
    assert pii.digest(none).collect() == [] and pii.redact(none).count() == 0


def test_counts_of_every_kind(as_docs):
    texts = ["mail a.b@x.org and 10.0.0.1 now", "10.0.0.1 10.0.0.2 c@d.org", "+1 (437) 555-0199 then 4111111111111111 then e@f.org and g@h.org", "1.2.3.4", "", None]
    for r in pii.digest(as_docs(list(enumerate(texts)))).collect():
        kinds = [k for _, k, _ in plain(texts[r.doc_id] or "")]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in range(4)], r


def test_contexts_find_unseen_identifiers(spark, as_docs):
    rng = random.Random(4)
    rows = [(k, f"some words here call +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} today and é more") for k in range(30)]
    rows += [(100, "some words here call 1 (437) 555-0199 today and more"), (101, "a serial 12345678901 of no context"), (102, "mail a.b@x.org and 10.0.0.1 now")]
    docs = as_docs(rows + [rows[30]])
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    assert got[100].spans == "phone:21:37" and got[100].n_phone == 0 and got[100].n_added == 1
    assert got[101].spans == "" and got[102].spans == "email:5:14,ip:19:27"
    assert got[0].spans == digest(rows[0][1]) and got[0].n_added == 0
    clean = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert clean[100].text == "some words here call [PHONE] today and more" and clean[100].n_chars == len(clean[100].text)
    assert clean[102].text == "mail [EMAIL] and [IP] now" and clean[101].text == rows[31][1]
    assert pii.redact(docs).columns == docs.columns and pii.redact(docs).count() == len(rows) + 1


def plain_scores(edges, seeds, kind):
    """Rounds until nothing moves; ``edges``: pattern to instances."""
    r, s = {}, {}
    for _ in range(20_000):
        s = {p: sum(seeds.get(i) == kind if i in seeds else r.get(i, 0.0) for i in x) / (len(x) + 1) for p, x in edges.items()}
        of = {}
        for p, x in edges.items():
            for i in x:
                of.setdefault(i, []).append(s[p])
        new = {i: sum(v) / len(v) for i, v in of.items() if i not in seeds}
        if all(abs(new[i] - r.get(i, 0.0)) < 1e-9 for i in new):
            return s
        r = new
    raise AssertionError


def test_scores_equal_the_fixed_point(spark):
    rng = random.Random(6)
    seeds = {i: rng.choice([0, 0, 3]) for i in range(60)}
    found = [(i, seeds.get(i, -1), [f"p{rng.randrange(6)}", f"q{rng.randrange(4)}", f"x{i % 2}"]) for i in range(400)]
    edges = {}
    for i, _, patterns in found:
        for p in set(patterns):
            edges.setdefault(p, set()).add(i)
    edges = {p: x for p, x in edges.items() if sum(i in seeds for i in x) >= 5}
    got = pii.score_patterns(spark.createDataFrame(found, "ident long, kind int, patterns array<string>")).collect()
    assert {r.pattern for r in got} == set(edges)
    for kind in (0, 3):
        want = plain_scores(edges, seeds, kind)
        assert all(abs(r[f"s{kind}"] - want[r.pattern]) < 2e-4 for r in got)


def test_as_many_unseen_as_seeds(spark, as_docs):
    rng = random.Random(7)
    numbers = rng.sample(range(10_000), 200)
    rows = [(k, f"some words here call +1 (437) 555-{n:04d} today and more") for k, n in enumerate(numbers[:100])]
    rows += [(100 + k, f"some words here call 437 555 {n:04d} today and more") for k, n in enumerate(numbers[100:])]
    got = {r.doc_id: r for r in pii.digest(as_docs(rows)).collect()}
    assert all(got[k].spans == "phone:21:38" and got[k].n_added == 0 for k in range(100))
    assert all(got[k].spans == "phone:21:33" and got[k].n_added == 1 for k in range(100, 200))
    assert all(r.text == "some words here call [PHONE] today and more" for r in pii.redact(as_docs(rows)).collect())


def test_confident_slots_propose_what_stands_in_them(spark, as_docs):
    """Identifiers of other shapes in a context of many seeds; the same groups
    in other contexts, and plain words in the context, stay."""
    rows = [(k, f"then write mail at name{k}@host{k % 7}.org please and wait") for k in range(40)]
    rows += [(100 + k, f"our server sits at 10.0.{k}.{k + 1}, behind a wall") for k in range(40)]
    other = {200: ("then write mail at alice (at) example.com please and wait", "email", "alice (at) example.com"),
             201: ("our server sits at 2001:db8::ff00:42, behind a wall", "ip", "2001:db8::ff00:42"), 202: ("our server sits at 10,0,0,1, behind a wall", "ip", "10,0,0,1"),
             203: ("then write mail at once please and wait", None, None), 204: ("we met alice (at) example.com at 10,0,0,1 on 2001:db8::ff00:42 there", None, None)}
    docs = as_docs(rows + [(k, t) for k, (t, _, _) in other.items()] + [(200, other[200][0])])
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    for k, (text, kind, ident) in other.items():
        if kind is None:
            assert got[k].spans == "" and clean[k] == text
        else:
            at = text.index(ident)
            assert got[k].spans == f"{kind}:{at}:{at + len(ident)}" and got[k].n_added == 1 and got[k].n_email == got[k].n_ip == 0
            assert clean[k] == text.replace(ident, f"[{kind.upper()}]")
    assert all(got[k].n_added == 0 for k in range(40)) and pii.digest(docs).count() == len(rows) + len(other) + 1


def test_a_slot_of_mostly_other_things_proposes_nothing(as_docs):
    rows = [(k, f"we will meet you at 10.0.{k}.{k + 1} today or later") for k in range(12)]
    rows += [(100 + k, f"we will meet you at {k}:30 today or later") for k in range(24)]
    assert all(r.n_added == 0 for r in pii.digest(as_docs(rows)).collect())


def test_proposals_against_all_groups():
    """Every group of up to four words with a telling word in an open slot."""
    rng = random.Random(8)
    for _ in range(300):
        words = [rng.choice(["a", "b1", "x.y", "c,", "at", "(at)", "::1", "mail", "z@"]) for _ in range(rng.randint(0, 12))]
        text = rng.choice([" ", "  ", "\n"]).join(words)
        spots = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        want = set()
        for i in range(len(spots)):
            for j in range(i, min(i + 4, len(spots))):
                if any(pii._TELLING.search(text[s:e]) for s, e in spots[i:j + 1]):
                    s, e = spots[i][0], spots[j][0] + len(text[slice(*spots[j])].rstrip(pii._CLOSING))
                    want |= {(s, e)} if e > s else set()
        assert {(x["start"], x["end"]) for x in pii._proposals(text, [], lambda slot: True)} == want, text
        assert pii._proposals(text, [], lambda slot: False) == []


def test_proposals_of_long_texts_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1 " * 30_000, "a.b" * 100_000, "1" + " " * 300_000 + "1", ("a" * 100_000 + " 1 ") * 3):
        pii._proposals(text, [(k, k + 1) for k in range(0, 1000, 3)], lambda slot: False)


def test_overlaps_are_cut_once():
    assert pii._cut("x 1.2.3.4 y", [(2, 1, 9), (4, 2, 9)]) == "x [IP] y"
