"""Conversation repair against every possible repair, and awkward tables."""
import hashlib
import itertools
import random
import re
import zlib

from airshed.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, c string, audit string, h string, late int"


def every_repair(rows):
    """(cost, audit, turns) of each repair with at most two inserts between rows."""
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]

    def walk(i):
        for added in inserts:
            head = (2 * len(added), "I" * len(added), [(r, "") for r in added])
            if i == len(rows):
                yield head
                continue
            role, text, must_go, truncated = rows[i]
            own = [(3, "D", [])]
            if not must_go:
                own += [(truncated, "K", [(role, text)])] + [(2 + truncated, "R", [(r, text)]) for r in ("user", "assistant")]
            for cost, letter, turns in own:
                for c, a, t in walk(i + 1):
                    yield head[0] + cost + c, head[1] + letter + a, head[2] + turns + t
    return (x for x in walk(0) if GRAMMAR.fullmatch("".join(r[:1] for r, _ in x[2])))


def expected(table):
    """The result rows by brute force, and by the plain search for longer ones."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            end = text.rstrip(SPACE)[-1:]
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None)
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
        ready = [(r, t, f in ("blank", "duplicate"), f == "truncated") for (_, r, t), f in zip(rows, faults)]
        if len(rows) <= 3:
            cost, audit, done = min(every_repair(ready), key=lambda x: x[:2])
            lines = "\n".join(f"{r}:{t}" for r, t in done)
        else:
            cost, audit = repair.cheapest_repair([(r[:1], g, t) for r, _, g, t in ready])
            lines = None
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, lines)
    return out


def check(found, table):
    want = expected(table)
    assert len(found) == len(want)
    for r in found:
        *numbers, lines = want[r["conv_id"]]
        assert [r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")] == numbers
        if lines is not None:
            assert r["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()


def test_search_finds_the_cheapest_of_all_repairs():
    rng = random.Random(5)
    for n in range(4):
        for _ in range(40 if n else 1):
            rows = [(rng.choice(["system", "user", "user", "assistant", "tool", " "]), str(k), rng.random() < 0.2, rng.random() < 0.3) for k in range(n)]
            want = min(every_repair(rows), key=lambda x: x[:2])
            assert repair.cheapest_repair([(r[:1], g, t) for r, _, g, t in rows]) == want[:2]


def exhaustive(rows):
    """Least (cost, audit) per state, row by row, all prefixes compared."""
    best = {repair.NOTHING: (0, "")}

    def inserts():
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                t = repair._NEXT[s]
                best[t] = min(best.get(t, (1 << 60, "")), (c + 2, a + "I"))
    inserts()
    for initial, must_go, truncated in rows:
        new = {}
        for s, (c, a) in best.items():
            options = [(3, "D", s)]
            if not must_go:
                options.append((2 + truncated, "R", repair._NEXT[s]))
                after = repair._kept(initial, s)
                if after is not None:
                    options.append((int(truncated), "K", after))
            for cost, letter, t in options:
                new[t] = min(new.get(t, (1 << 60, "")), (c + cost, a + letter))
        best.clear()
        best.update(new)
        inserts()
    return min(best[s] for s in (repair.NOTHING, repair.ASSISTANT) if s in best)


def test_long_conversations():
    rng = random.Random(6)
    for n in (10, 60, 500):
        rows = [(rng.choice("suuaax"), rng.random() < 0.15, rng.random() < 0.3) for _ in range(n)]
        assert repair.cheapest_repair(rows) == exhaustive(rows)
    assert repair.cheapest_repair([("u", False, False), ("a", False, False)] * 50_000) == (0, "K" * 100_000)


def test_bounds_never_exceed_a_repair():
    rng = random.Random(7)
    rows = [(rng.choice("suax"), rng.random() < 0.3, rng.random() < 0.3) for _ in range(30)]
    bounds = repair.suffix_bounds(rows)
    assert bounds[0][repair.NOTHING] == repair.cheapest_repair(rows)[0]
    assert all(bounds[i][0] == repair.cheapest_repair(rows[i:])[0] for i in range(31))


def table_of(rng):
    rows = []
    for conv in [*range(60), None]:
        for k in range(rng.randint(0, 3) if conv != 59 else 300):
            turn = rng.choice([None, k, k, k + 2])
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "assistant", "tool", None]),
                         rng.choice(["Hi.", "Hi.", "What now?", "and then", "", " \n", None, "Fine! ", "é…", "long " * 3000 + "end."])))
    return rows


def test_against_brute_force(spark):
    table = table_of(random.Random(8))
    table += table[:5]  # repeated rows
    full = [(*r, "x", "K", "h", 1) for r in table]
    rows = spark.createDataFrame(full, SCHEMA).repartition(5)
    found = repair.repair(repair.damage(rows), rows)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    check(found.collect(), table)


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "assistant", "Yes"), (2, 0, "tool", ""), (3, 5, "system", "Be kind."), (3, 6, "user", "So?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = [tuple(r) for r in repair.repaired_turns(df).orderBy("conv_id", "turn").collect()]
    assert found == [(1, 0, "K", "user", "Hello."), (1, 1, "I", "assistant", ""), (1, 2, "K", "user", "Again."), (1, 3, "K", "assistant", "Yes"),
                     (3, 0, "K", "system", "Be kind."), (3, 1, "K", "user", "So?"), (3, 2, "I", "assistant", "")]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damage(none), none).count() == 0
    assert repair.repaired_turns(none).count() == 0
