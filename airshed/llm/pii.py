"""Personal data: bootstrapped contextual extraction.

Four patterns find the base spans (email, ip, card, phone). They are the
seeds. Every seed, and every other candidate (a group of at least SEVEN
digits, or a word with '@'), is a mention with lexical patterns: its two
left words; its left word and shape; its right word and shape; the words on
both sides. Spark builds the pattern-instance graph and scores, to their fixed point, a
pattern for a kind by the mean reliability of its instances (seeds are 1)
and an instance by the mean score of its patterns with enough seeds. A
pattern of high confidence then turns other candidates in its context into
spans of its kind. Base spans always stay.

Identifiers need not look like the seeds ("alice (at) example.com", an IPv6
address, six digits). So a confident slot (two words on the left, one on the
right) also proposes what else stands in it: groups of at most WIDE words, of
which one holds a digit, an '@', or a stop, colon or comma inside. It does so only
while it has at least as many distinct seeds as distinct proposals. Spans of
two slots of a text may overlap; both are given, and redact marks their union.

Cases: a null text counts as empty; texts without mentions give no spans;
repeated rows give the same spans each and count once in the graph; ties
between kinds go to the first in KINDS. Contexts keep at most EDGE characters
of a word, so a very long word can't blow up the graph. Other columns are
carried (redact) or ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import column_function, whole_text
from airshed.session import materialize

KINDS = ["email", "ip", "card", "phone"]
#: Digits of a candidate, characters of a context word.
SEVEN, EDGE = 7, 32
#: Words and characters of a proposed group; bits of the filter of slots (its size is fixed).
WIDE, LONG, SLOT_BITS = 4, 256, 22

# The base patterns. Digit runs are taken whole (no retry inside
# a run can succeed where its start failed), which keeps them linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_GROUP = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9])++")
_SPACE = "\x20\t\n\x0b\x0c\r"
_TELLING = re.compile(r"[0-9@]|[.:,](?=[A-Za-z0-9:])")
_RUN = re.compile(r"[^\x20\x09-\x0D]+")
_CLOSING = ".,;:!?"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _emails(t: str) -> list[tuple[int, int]]:
    """Around each '@': the run of local characters before it, and a domain
    after it. The run starts after the last match at the earliest."""
    out, floor = [], 0
    at = t.find("@")
    while at >= 0:
        s = at
        while s > floor and t[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(t, at + 1) if s < at else None
        if m:
            out.append((s, m.end()))
            floor = m.end()
        at = t.find("@", m.end() if m else at + 1)
    return out


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(t)]
    if _DIGIT.search(t):
        for m in _IP.finditer(t):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(t):
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(t):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _candidates(t: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Digit groups and words with '@' that touch no base span."""
    found = [(m.start(), m.end()) for m in _GROUP.finditer(t) if len(_digits(m[0])) >= SEVEN]
    at = t.find("@")
    while at >= 0:
        s = e = at
        while s > 0 and t[s - 1] not in _SPACE:
            s -= 1
        while e < len(t) and t[e] not in _SPACE:
            e += 1
        if e - s > 2:
            found.append((s, e))
        at = t.find("@", e)
    out, k, reach = [], 0, -1
    spans = sorted((s, e) for s, _, e in taken)
    for s, e in sorted(found):
        while k < len(spans) and spans[k][0] < e:
            reach = max(reach, spans[k][1])
            k += 1
        if reach <= s:
            out.append((s, e))
            reach = max(reach, e)
    return out


def _word_before(t: str, at: int) -> tuple[str, int]:
    while at > 0 and t[at - 1] in _SPACE:
        at -= 1
    end = at
    while at > 0 and t[at - 1] not in _SPACE and end - at < EDGE:
        at -= 1
    return t[at:end].lower(), at


def _word_after(t: str, at: int) -> str:
    while at < len(t) and t[at] in _SPACE:
        at += 1
    end = at
    while end < len(t) and t[end] not in _SPACE and end - at < EDGE:
        end += 1
    return t[at:end].lower()


def _shape(s: str) -> str:
    """Letters as one a; digit runs of up to three as one 9, longer ones with
    their length; the rest as it is."""
    s = re.sub(r"[^\W\d_]+", "a", s[:4 * EDGE])
    return re.sub(r"[0-9]+", lambda m: "9" if len(m[0]) <= 3 else f"9{{{len(m[0])}}}", s)[:2 * EDGE]


def _slot(further: str, left: str, right: str) -> str:
    return f"LLR {further} {left} {right}"


def _mention(t: str, s: int, e: int, kind: int) -> dict:
    left, at = _word_before(t, s)
    further, _ = _word_before(t, at)
    right, shape = _word_after(t, e), _shape(t[s:e])
    return {"kind": kind, "start": s, "end": e, "ident": xxhash.xxh64_intdigest(t[s:e].lower().encode()) - (1 << 63),
            "patterns": [f"LL {further} {left}", f"LS {left} {shape}", f"RS {right} {shape}", f"LR {left} {right}", _slot(further, left, right)]}


_MENTIONS = "array<struct<kind:int,start:int,end:int,ident:bigint,patterns:array<string>>>"
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _make_mentions():
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("ident", pa.int64()), ("patterns", pa.list_(pa.string()))]))

    def apply(batch: pa.Array) -> pa.Array:
        out = []
        for t in batch:
            t = t.as_py() or ""
            base = base_spans(t)
            out.append([_mention(t, s, e, k) for s, k, e in base] + [_mention(t, s, e, -1) for s, e in _candidates(t, base)])
        return pa.array(out, kind)
    return apply


def mentions(text: Column) -> Column:
    """Base spans (kind 0 to 3) and other candidates (kind -1) of a text."""
    return column_function(_make_mentions, _MENTIONS)(text)


def _words_left(t: str, at: int, most: int) -> list[int]:
    """Starts of up to ``most`` words before ``at``, the nearest first, that
    reach back no more than LONG characters."""
    out, floor = [], max(0, at - LONG)
    while len(out) < most:
        while at > floor and t[at - 1] in _SPACE:
            at -= 1
        end = at
        while at > floor and t[at - 1] not in _SPACE:
            at -= 1
        if at == end or at == floor > 0:
            break
        out.append(at)
    return out


def _proposals(t: str, taken: list[tuple[int, int]], open_slot) -> list[dict]:
    """Groups of up to WIDE words and LONG characters around a telling word,
    in slots that ``open_slot`` lets through, that touch nothing in ``taken``
    (sorted, disjoint)."""
    out, seen, done = [], set(), 0
    hit = _TELLING.search(t)
    while hit:
        first, start = hit.start(), done
        while first > start and t[first - 1] not in _SPACE:
            first -= 1
        done = _RUN.match(t, hit.start()).end()
        if done - first <= LONG and not _touches(taken, first, done):
            ends = [done]
            for _ in range(WIDE - 1):
                if (more := _RUN.search(t, ends[-1])) is None:
                    break
                ends.append(more.end())
            for back, s in enumerate([first, *_words_left(t, first, WIDE - 1)]):
                left, at = _word_before(t, s)
                further, _ = _word_before(t, at)
                for e in ends[:WIDE - back]:
                    while e > s and t[e - 1] in _CLOSING:
                        e -= 1
                    if not s < e <= s + LONG or (s, e) in seen or _touches(taken, s, e):
                        continue
                    slot = _slot(further, left, _word_after(t, e))
                    if open_slot(slot):
                        seen.add((s, e))
                        out.append({"slot": slot, "start": s, "end": e, "ident": xxhash.xxh64_intdigest(t[s:e].lower().encode()) - (1 << 63)})
        hit = _TELLING.search(t, done)
    return out


def _touches(spans: list[tuple[int, int]], s: int, e: int) -> bool:
    """Whether (s, e) overlaps one of the sorted, disjoint ``spans``."""
    k = bisect_left(spans, (e, 0))
    return k > 0 and spans[k - 1][1] > s


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_PROPOSALS = "array<struct<slot:string,start:int,end:int,ident:bigint>>"


def _proposing(bits: bytes):
    """A column function: the proposals of a text through a filter of slots
    (a bit per hash value; some wrong slots pass, no right one is held)."""
    def make():
        kind = pa.list_(pa.struct([("slot", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("ident", pa.int64())]))

        def open_slot(slot: str) -> bool:
            at = xxhash.xxh64_intdigest(slot.encode(), seed=42) & ((1 << SLOT_BITS) - 1)
            return bool(bits[at >> 3] >> (at & 7) & 1)

        def apply(batch: pa.Array) -> pa.Array:
            out = []
            for t in batch:
                t = t.as_py() or ""
                base = base_spans(t) if _TELLING.search(t) else []
                out.append(_proposals(t, _union([(s, e) for s, _, e in base] + _candidates(t, base)), open_slot))
            return pa.array(out, kind)
        return apply
    return column_function(make, _PROPOSALS)


def _slot_filter(slots: DataFrame) -> bytes:
    """2^SLOT_BITS bits, one set per slot's hash; at most 2^(SLOT_BITS - 6)
    rows reach the driver, whatever the number of slots."""
    at = slots.select(F.xxhash64("pattern").bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).alias("at"))
    words = at.select(F.shiftright("at", 6).alias("w"), F.expr("shiftleft(1L, cast(at % 64 AS int))").alias("b"))
    bits = np.zeros(1 << (SLOT_BITS - 6), dtype="<i8")
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        bits[r.w] = r.b
    return bits.tobytes()


def _proposed(docs: DataFrame, sure: DataFrame) -> DataFrame | None:
    """(doc_id, h, start, end, score, as_kind): what stands in the confident
    slots of ``sure`` beside seeds and candidates; None without such slots."""
    slots = materialize(sure.where(F.col("pattern").startswith("LLR ")), "pii-slots")
    bits = _slot_filter(slots)
    if not any(bits):
        return None
    found = docs.select("doc_id", F.xxhash64(whole_text()).alias("h"), F.explode(_proposing(bits)(whole_text())).alias("m")).select("doc_id", "h", "m.*")
    found = materialize(found.join(slots.withColumnRenamed("pattern", "slot"), "slot"), "pii-proposals")
    few = found.select("slot", "ident", "n_seeds").distinct().groupBy("slot", "n_seeds").agg(F.count(F.lit(1)).alias("n")).where("n <= n_seeds").select("slot")
    return found.join(few, "slot").select("doc_id", "h", "start", "end", "score", "as_kind")


def score_patterns(found: DataFrame, tolerance: float = 1e-4, support: int = 5) -> DataFrame:
    """(pattern, n_seeds, s0..s3): the score of each pattern for each kind.

    ``found`` has kind, ident, patterns, a row per mention. A pattern needs
    ``support`` distinct seeds to score. Copies of a text add no weight: the
    graph has one edge per pattern and instance.

    With n instances, of them u unseen, S the seeds' sum and r the mean score
    of an unseen one's patterns, scores solve (n + 1) s - sum of r = S: linear,
    symmetric, positive definite, so by conjugate gradients over the written
    edges; plain rounds would need about u / (n - u) of them. The rows of the
    system sum to n - u + 1, so no score is further from its solution than the
    largest miss over that: the rounds end where this is below ``tolerance``."""
    edges = found.select("ident", "kind", F.explode(F.array_distinct("patterns")).alias("pattern"))
    # An instance that is a seed somewhere is one everywhere.
    seeds = found.where("kind >= 0").groupBy("ident").agg(*[F.max((F.col("kind") == k).cast("double")).alias(f"r{k}") for k in range(4)])
    useful = edges.where("kind >= 0").groupBy("pattern").agg(F.countDistinct("ident").alias("n_seeds")).where(F.col("n_seeds") >= support)
    seeds = materialize(seeds, "pii-seeds")
    edges = materialize(edges.select("pattern", "ident").distinct().join(useful, "pattern").join(seeds, "ident", "left"), "pii-edges")
    unseen = materialize(edges.where("r0 IS NULL").select("pattern", "ident"), "pii-unseen")
    given = edges.groupBy("pattern").agg(F.max("n_seeds").alias("n_seeds"), (F.count(F.lit(1)) + 1).cast("double").alias("n"), (F.count("r0") + 1).cast("double").alias("m"),
                                         *[F.coalesce(F.sum(f"r{k}"), F.lit(0.0)).alias(f"b{k}") for k in range(4)])
    # Exact where an unseen instance's patterns score the same.
    state = materialize(given.select("*", *[(F.col(f"b{k}") / F.col("m")).alias(f"s{k}") for k in range(4)]), "pii-patterns")

    def applied(state: DataFrame, name: str) -> DataFrame:
        """``state`` with q0..: the system's matrix times ``name``0.."""
        of_ident = unseen.join(state.select("pattern", *[f"{name}{k}" for k in range(4)]), "pattern").groupBy("ident").agg(*[F.avg(f"{name}{k}").alias(f"a{k}") for k in range(4)])
        back = unseen.join(of_ident, "ident").groupBy("pattern").agg(*[F.sum(f"a{k}").alias(f"a{k}") for k in range(4)])
        held = state.join(back, "pattern", "left")
        return held.select(*state.columns, *[(F.col("n") * F.col(f"{name}{k}") - F.coalesce(f"a{k}", F.lit(0.0))).alias(f"q{k}") for k in range(4)])

    def sums(state: DataFrame, *columns: Column) -> list[list[float]]:
        row = [x or 0.0 for x in state.agg(*columns).first()]
        return [row[k:k + 4] for k in range(0, len(row), 4)]

    def misses(rest: list[Column]) -> list[Column]:
        return [*[F.sum(x * x / F.col("n")) for x in rest], *[F.max(F.abs(x) / F.col("m")) for x in rest]]

    first = materialize(applied(state, "s"), "pii-patterns")
    rest = [F.col(f"b{k}") - F.col(f"q{k}") for k in range(4)]
    square, miss = sums(first, *misses(rest))
    keep = ["pattern", "n_seeds", "n", "m"]
    state = first.select(*keep, *[f"s{k}" for k in range(4)], *[x.alias(f"e{k}") for k, x in enumerate(rest)], *[(x / F.col("n")).alias(f"p{k}") for k, x in enumerate(rest)])
    while max(miss) >= tolerance:
        step = materialize(applied(state, "p"), "pii-patterns")
        [curve] = sums(step, *[F.sum(F.col(f"p{k}") * F.col(f"q{k}")) for k in range(4)])
        length = [a / b if b > 0 else 0.0 for a, b in zip(square, curve, strict=True)]
        score = [F.col(f"s{k}") + F.lit(x) * F.col(f"p{k}") for k, x in enumerate(length)]
        rest = [F.col(f"e{k}") - F.lit(x) * F.col(f"q{k}") for k, x in enumerate(length)]
        last, (square, miss) = square, sums(step, *misses(rest))
        turn = [a / b if b > 0 else 0.0 for a, b in zip(square, last, strict=True)]
        state = step.select(*keep, *[x.alias(f"s{k}") for k, x in enumerate(score)], *[x.alias(f"e{k}") for k, x in enumerate(rest)],
                            *[(x / F.col("n") + F.lit(t) * F.col(f"p{k}")).alias(f"p{k}") for k, (x, t) in enumerate(zip(rest, turn, strict=True))])
    return state.select("pattern", "n_seeds", *[f"s{k}" for k in range(4)])


def _discovered(docs: DataFrame, rows: DataFrame, confidence: float, tolerance: float, support: int) -> DataFrame:
    """(doc_id, h, added): the spans that confident patterns add to a text."""
    flat = rows.select("doc_id", "h", F.explode("found").alias("m")).select("doc_id", "h", "m.*").distinct()
    scores = score_patterns(flat, tolerance, support)
    best = F.greatest(*[F.col(f"s{k}") for k in range(4)])
    kind = F.coalesce(*[F.when(F.col(f"s{k}") == best, k) for k in range(4)])
    sure = scores.where(best >= confidence - tolerance)  # scores are exact to the tolerance
    sure = materialize(sure.select("pattern", "n_seeds", best.alias("score"), kind.alias("as_kind")), "pii-sure")
    hits = flat.where("kind < 0").select("doc_id", "h", "start", "end", F.explode(F.array_distinct("patterns")).alias("pattern")).join(sure, "pattern")
    hits = hits.select("doc_id", "h", "start", "end", "score", "as_kind")
    if (more := _proposed(docs, sure)) is not None:
        hits = hits.unionByName(more)
    chosen = hits.groupBy("doc_id", "h", "start", "end").agg(F.max(F.struct("score", (-F.col("as_kind")).alias("k"))).alias("b"))
    return chosen.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("start", (-F.col("b.k")).cast("int").alias("kind"), "end"))).alias("added"))


def extract(docs: DataFrame, confidence: float = 0.9, tolerance: float = 1e-4, support: int = 5) -> DataFrame:
    """(doc_id, base, added) per row of ``docs``: arrays of (start, kind,
    end), kind an index in KINDS."""
    rows = materialize(docs.select("doc_id", F.xxhash64(whole_text()).alias("h"), mentions(whole_text()).alias("found")), "pii-mentions")
    added = materialize(_discovered(docs, rows, confidence, tolerance, support), "pii-added").withColumnRenamed("doc_id", "id").withColumnRenamed("h", "hh")
    base = F.transform(F.filter("found", lambda m: m["kind"] >= 0), lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    joined = rows.join(added, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hh")), "left")
    return joined.select("doc_id", base.alias("base"), F.coalesce("added", F.array().cast(_SPANS)).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined, in the order given."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def digest(docs: DataFrame, confidence: float = 0.9, tolerance: float = 1e-4, support: int = 5) -> DataFrame:
    """Per document: counts of base spans by kind, the SHA-256 of the base
    spans, all spans, and the number of added ones."""
    found = extract(docs, confidence, tolerance, support)
    kinds = F.transform("base", lambda s: s["kind"])  # filter's second lambda parameter would be the place, not a kind
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    every = F.sort_array(F.concat("base", "added"))
    return found.select("doc_id", *count, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(every).alias("spans"), F.size("added").cast("bigint").alias("n_added"))


def _cut(t: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; where spans overlap, one
    mark of the first kind covers them all."""
    out, at, k = [], 0, 0
    spans = sorted(spans)
    while k < len(spans):
        s, kind, e = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < e:
            e = max(e, spans[k][2])
            k += 1
        out += [t[at:s], f"[{KINDS[kind].upper()}]"]
        at = e
    return "".join([*out, t[at:]])


def _cut_batches(it: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, added in it:
        out = []
        for t, more in zip(texts, added, strict=True):
            if (t := t.as_py()) is not None:
                spans = base_spans(t) + [(x["start"], x["kind"], x["end"]) for x in more.as_py() or []]
                t = _cut(t, spans) if spans else t
            out.append(t)
        yield pa.array(out, pa.string())


def redact(docs: DataFrame, confidence: float = 0.9, tolerance: float = 1e-4, support: int = 5) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets,
    and ``n_chars``, where there is one, counted anew for changed texts. A
    null text stays null."""
    rows = materialize(docs.select("doc_id", F.xxhash64(whole_text()).alias("h"), mentions(whole_text()).alias("found")), "pii-mentions")
    added = materialize(_discovered(docs, rows, confidence, tolerance, support), "pii-added")
    h = F.xxhash64(whole_text())
    extra = added.select(F.col("doc_id").alias("__pii_id"), F.col("h").alias("__pii_h"), F.col("added").alias("__pii_added"))
    joined = docs.join(extra, F.col("doc_id").eqNullSafe(F.col("__pii_id")) & (h == F.col("__pii_h")), "left")
    clean = joined.withColumn("__pii_text", F.arrow_udf(_cut_batches, "string")(F.col("text"), F.col("__pii_added")))
    changed = ~F.col("text").eqNullSafe(F.col("__pii_text"))
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out["text"] = F.col("__pii_text").alias("text")
    if "n_chars" in out:
        out["n_chars"] = F.when(changed, F.length("__pii_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars")
    return clean.select(*out.values())
