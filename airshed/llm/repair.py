"""Conversation repair by depth-first branch and bound.

A conversation's rows, by turn (null turns first; ties by role, then text),
are edited until their role initials read (s?(ua)+)?: an optional system
turn, then user and assistant in turn, ending with the assistant, or nothing.
A row's first fault counts: blank (no character but ASCII white space),
duplicate (its role and text were seen earlier in the conversation),
truncated (its last character but white space is not one of . ! ?). Keep
costs 0, Rerole to user or assistant 2, Delete 3 and Insert of an empty user
or assistant turn 2. Blank and duplicate rows must be deleted; a truncated row
that stays adds 1. Of the cheapest repairs, the one whose audit (the edits'
initials in order) is least in ASCII is taken.

Search: a node is (rows done, state); the state is what the last output turn
was. ``suffix_bounds`` gives the least cost at which each node can be
finished if ties didn't matter. A first dive along the bounds gives the
incumbent (cost, audit); then an explicit stack is worked off depth first,
edits in ASCII order. A node is cut if its cost and bound exceed the
incumbent's cost, or by its own dominance entry: prefixes come in ASCII order,
so a later prefix of the same node is worse unless it costs less. (Equal
costs at one node mean that neither audit is the start of the other, for a
longer one has more inserts.) The empty stack proves the incumbent best.

Scale: what was seen earlier comes from one aggregation on (conversation,
digest of role and text), so copies of one turn are combined before the
shuffle. Rows then stream, sorted by conversation, through two passes: the
first keeps a few bytes a row and gives the audits; the second gets each audit
ahead of its conversation's rows and applies it row by row. No text is held;
a task holds an audit and its search, which the result holds as well. A
conversation is one stream, because its digest is one SHA-256.

Cases: null role or text: one space, so the text is blank; a null turn is no
turn for ``gaps`` and comes first; a null conv_id is a conversation of its
own; a role whose initial isn't s, u or a fits nowhere and can only be reroled
or deleted; repeated rows are duplicates; an empty table gives no rows; texts
are whole; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after a system, a user, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: A repair may end here.
_ENDS = (NOTHING, ASSISTANT)
#: What a user or assistant turn must be in each state, as the next state.
_NEXT = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
_D, _I, _K, _R = b"DIKR"
_SPACE = " \t\n\x0b\x0c\r"

#: A row of the search: the role's initial, must it go, is it truncated.
Row = tuple[str, bool, bool]


def _kept(initial: str, state: int) -> int | None:
    """The state after keeping a row, None if it doesn't fit."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial in ("u", "a") and _NAMES[_NEXT[state]][0] == initial:
        return _NEXT[state]
    return None


def _edits(rows: list[Row], i: int, state: int) -> list[tuple[int, int, int, int]]:
    """(letter, cost, rows done, state) of each edit at a node, ASCII order."""
    out = [(_I, INSERT, i, _NEXT[state])]
    if i < len(rows):
        initial, must_go, truncated = rows[i]
        out.insert(0, (_D, DELETE, i + 1, state))
        if not must_go:
            extra = TRUNCATED if truncated else 0
            after = _kept(initial, state)
            if after is not None:
                out.append((_K, KEEP + extra, i + 1, after))
            out.append((_R, REROLE + extra, i + 1, _NEXT[state]))
    return out


def suffix_bounds(rows: list[Row]) -> list[list[int]]:
    """bounds[i][state]: no repair of rows i, i+1, ... from the state costs
    less. From the last row back; an insert leads to another state of the
    same row, and at most two in a row can help."""
    n = len(rows)
    bounds: list[list[int]] = [[]] * (n + 1)
    for i in range(n, -1, -1):
        if i == n:
            here = [0 if s in _ENDS else INSERT * (3 * len(_NEXT)) for s in range(4)]
        else:
            here = [min(cost + bounds[j][after] for letter, cost, j, after in _edits(rows, i, s) if letter != _I) for s in range(4)]
        for _ in range(2):
            here = [min(here[s], INSERT + here[_NEXT[s]]) for s in range(4)]
        bounds[i] = here
    return bounds


def _dive(rows: list[Row], bounds: list[list[int]]) -> tuple[int, bytes]:
    """The repair that follows the least cost and bound, the first incumbent."""
    i, state, cost, audit = 0, NOTHING, 0, bytearray()
    while not (i == len(rows) and state in _ENDS):
        letter, more, i, state = min(_edits(rows, i, state), key=lambda e: (e[1] + bounds[e[2]][e[3]], e[0]))
        cost += more
        audit.append(letter)
    return cost, bytes(audit)


def cheapest_repair(rows: list[Row]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, the ASCII-least audit on ties."""
    n, bounds = len(rows), suffix_bounds(rows)
    best = _dive(rows, bounds)
    expanded: list[list[int | None]] = [[None] * 4 for _ in range(n + 1)]
    path, stack = bytearray(), [(0, 0, 0, NOTHING, 0)]
    while stack:
        depth, letter, i, state, cost = stack.pop()
        del path[depth:]
        if letter:
            path.append(letter)
        if cost + bounds[i][state] > best[0]:
            continue
        seen = expanded[i][state]
        if seen is not None and seen <= cost:
            continue
        expanded[i][state] = cost
        if i == n and state in _ENDS:
            best = min(best, (cost, bytes(path)))
        for edit, more, j, after in reversed(_edits(rows, i, state)):
            stack.append((len(path), edit, j, after, cost + more))
    return best[0], best[1].decode()


# ------------------------------------------------------------------ on Spark
def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults, by crc32 of
    "conv_id:turn" modulo 20: 0 drops the row, 1 empties its text, 2 removes
    its . ! ?, 3 repeats it, 4 makes it the user's. Nulls read as one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20).cast("bigint"))
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                                F.coalesce(F.col("text").cast("string"), blank).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def _key() -> Column:
    """A conversation's key, which a null conv_id has as well."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))


def _noted(rows: DataFrame) -> DataFrame:
    """The rows with their key, a digest of role and text, and their faults;
    ``late``: the same role and text stand at an earlier turn."""
    blank = F.lit(" ")
    plain = rows.select(_key().alias("c"), "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                        F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    said = plain.withColumn("h", F.md5(F.concat_ws("\0", "role", "text")))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = said.groupBy("c", "h").agg(F.min(at).alias("first"))
    end = F.rtrim("text", F.lit(_SPACE))
    return said.join(first, ["c", "h"]).select(
        "c", "turn", "role", "text", "h", (at > F.col("first")).alias("late"), (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation in one task's stream, its rows in order."""
    return rows.repartition("c").sortWithinPartitions("c", *first, F.col("turn").asc_nulls_first(), "role", "text")


class _Conversation:
    """What the first pass keeps of the conversation it reads."""

    def __init__(self, key: str):
        self.key, self.rows, self.last, self.turns = key, [], None, []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.distinct = 0

    def add(self, turn: int | None, initial: str, h: str, late: bool, blank: bool, truncated: bool) -> None:
        again = late or self.last == (turn, h)
        fault = "blank" if blank else "duplicate" if again else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        if self.rows and self.rows[-1][0] + initial not in _LEGAL:
            self.counts["illegal"] += 1
        if turn is not None and (not self.turns or self.turns[1] != turn):
            self.turns, self.distinct = [self.turns[0] if self.turns else turn, turn], self.distinct + 1
        self.rows.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
        self.last = (turn, h)

    def result(self) -> dict:
        cost, audit = cheapest_repair(self.rows)
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return {"c": self.key, "gaps": gaps, **self.counts, "cost": cost, "audit": audit}


_FOUND = pa.schema([("c", pa.string()), *((k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass: a row of ``_FOUND`` per conversation of the stream."""
    open_: _Conversation | None = None
    for batch in batches:
        done = []
        for key, *row in zip(*(batch.column(k).to_pylist() for k in ("c", "turn", "initial", "h", "late", "blank", "truncated")), strict=True):
            if open_ is None or open_.key != key:
                if open_:
                    done.append(open_.result())
                open_ = _Conversation(key)
            open_.add(*row)
        yield pa.RecordBatch.from_pylist(done, _FOUND)
    if open_:
        yield pa.RecordBatch.from_pylist([open_.result()], _FOUND)


class _Applied:
    """The output turns of one conversation, from its audit and its rows."""

    def __init__(self, key: str, audit: str):
        self.key, self.audit, self.at, self.state = key, audit, 0, NOTHING

    def _inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at, self.state = self.at + 1, _NEXT[self.state]
            yield "I", _NAMES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the inserts before a row and of the row."""
        yield from self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = SYSTEM if role[:1] == "s" else _NEXT[self.state]
            yield edit, role, text
        elif edit == "R":
            self.state = _NEXT[self.state]
            yield edit, _NAMES[self.state], text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        return self._inserts()


def _apply(sink: Callable) -> Callable:
    """Second pass: an audit row, then its conversation's rows. ``sink(key)``
    gets each output turn, and its ``end()`` returns result rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        applied = out = None

        def close() -> list[dict]:
            for turn in applied.rest():
                out.add(*turn)
            return out.end()
        for batch in batches:
            done = []
            for key, audit, role, text in zip(*(batch.column(k).to_pylist() for k in ("c", "audit", "role", "text")), strict=True):
                if audit is not None:
                    if applied:
                        done += close()
                    applied, out = _Applied(key, audit), sink(key)
                    continue
                for turn in applied.row(role, text):
                    out.add(*turn)
            if out:
                done += out.taken()
            yield pa.RecordBatch.from_pylist(done, sink.schema)
        if applied:
            yield pa.RecordBatch.from_pylist(close(), sink.schema)
    return run


class _Digest:
    """SHA-256 of the repaired conversation, a line ``role:text`` a turn."""
    schema = pa.schema([("c", pa.string()), ("repaired_sha256", pa.string())])

    def __init__(self, key: str):
        self.key, self.sha, self.lines = key, hashlib.sha256(), 0

    def add(self, edit: str, role: str, text: str) -> None:
        self.sha.update(("\n" * bool(self.lines) + f"{role}:{text}").encode())
        self.lines += 1

    def taken(self) -> list[dict]:
        return []

    def end(self) -> list[dict]:
        return [{"c": self.key, "repaired_sha256": self.sha.hexdigest()}]


class _Turns:
    """The repaired turns themselves, numbered from 0."""
    schema = pa.schema([("c", pa.string()), ("turn", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def __init__(self, key: str):
        self.key, self.n, self.rows = key, 0, []

    def add(self, edit: str, role: str, text: str) -> None:
        self.rows.append({"c": self.key, "turn": self.n, "edit": edit, "role": role, "text": text})
        self.n += 1

    def taken(self) -> list[dict]:
        rows, self.rows = self.rows, []
        return rows

    end = taken


def _audits(noted: DataFrame) -> DataFrame:
    rows = _in_order(noted).select("c", "turn", F.substring("role", 1, 1).alias("initial"), "h", "late", "blank", "truncated")
    return materialize(rows.mapInArrow(_search, "c string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"), "repair-audits")


def _applied(noted: DataFrame, audits: DataFrame, sink: Callable, schema: str) -> DataFrame:
    null = F.lit(None)
    marks = audits.select("c", "audit", null.cast(noted.schema["turn"].dataType).alias("turn"), null.cast("string").alias("role"), null.cast("string").alias("text"))
    rows = noted.select("c", null.cast("string").alias("audit"), "turn", "role", "text").unionAll(marks).withColumn("after", F.col("audit").isNull())
    return _in_order(rows, "after").select("c", "audit", "role", "text").mapInArrow(_apply(sink), schema)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), edit (K, R or I),
    role, text. A conversation that is deleted whole has no rows."""
    noted = materialize(_noted(rows), "repair-rows")
    names = rows.select(_key().alias("c"), "conv_id").distinct()
    turns = _applied(noted, _audits(noted), _Turns, "c string, turn bigint, edit string, role string, text string")
    return turns.join(names, "c").select("conv_id", "turn", "edit", "role", "text")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of each conversation of ``conversations`` (default: of the
    rows); one without rows has zeros, no audit and the empty text's digest."""
    noted = materialize(_noted(rows), "repair-rows")
    audits = _audits(noted)
    digests = _applied(noted, audits, _Digest, "c string, repaired_sha256 string")
    names = (rows if conversations is None else conversations).select(_key().alias("c"), "conv_id").distinct()
    found = names.join(audits, "c", "left").join(digests, "c", "left")
    counts = [F.coalesce(k, F.lit(0).cast("bigint")).alias(k) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
