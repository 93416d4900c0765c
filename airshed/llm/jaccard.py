"""N-gram Jaccard join with adaptive multi-match prefixes.

A text's set holds the 64-bit hashes of its distinct word shingles; two sets
link when 100 * intersection >= percent * union. With the tokens of every set
in one global order, a set of n tokens must share t = ceil(percent * n / 100)
with any partner. Two linked sets have their first l common tokens among the
first n - t + l tokens of each (their l-prefixes): so a pair whose sets use
l_a and l_b can be left out unless its prefixes share min(l_a, l_b) tokens.
A longer prefix costs postings and saves verifications.

1. Sets that are equal are one class, by a 128-bit digest; only classes are
   joined.
2. Sieve, all texts: with tokens ordered by hash and l = n / 10, a class must
   share l (of the smallest possible partner) prefix tokens with other classes.
   Texts that have a passage in common with others, but little else, go here.
   Tokens that many prefixes hold are noted as frequent; the bound FREQUENT
   on their number raises the frequency that counts, nothing else.
3. The classes left are hashed again and ordered anew: frequent tokens last,
   others by hash. From exact posting counts c, each document takes the l of
   LADDER with the least estimated cost: sum of c over the l-prefix for reading
   postings, and n * sum / l for verifying (at most sum / l documents can share
   l of its tokens).
4. Large groups: in each posting list, the member that shares most of its
   prefix is the hub, and every other member is compared with it. That is a
   number of pairs linear in the postings; verified links join most of a group
   of near copies at once.
5. Join: pairs of different components so far that share a posting list, are
   of fitting sizes and whose 512-bit parities differ in no more bits than
   their sets may, are counted by shared prefix tokens, and those with
   min(l_a, l_b) or more are verified on the whole sets.

Every link between sets of different components is found in step 5 and every
other link lies within a component, so components are exact (up to collisions
of 64-bit hashes within a pair of texts). They come from alternating stars.

Cases: null texts and texts without words have no shingle and link with
nothing (their component is their own doc_id); texts with fewer words than a
shingle have one, the whole sequence; a null doc_id is never a component's id
unless all its members' are null; repeated rows link with each other; texts
are whole; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import text_bytes, whole_text
from airshed.llm.simhash import components
from airshed.session import materialize, materialize_sized

#: The sieve's prefixes have one token more than the least per so many tokens.
SIEVE = 10
#: A token in so many prefixes may be frequent; at most so many tokens are.
HEAVY, FREQUENT = 32, 500_000
#: Choices of l.
LADDER = (1, 2, 3, 4, 6, 8, 12, 16)
#: Keys of classes are broadcast up to this written size.
BROADCAST_BYTES = 8 << 20
_SIGNATURE = 512

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)  # odd multipliers
_TEXTS = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text."""
    words = [t.lower().split() for t in texts]
    flat = [w for ws in words for w in ws]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    n = max(0, len(h) - shingle + 1)
    whole = np.zeros(n, np.uint64)
    for k in range(shingle):
        whole = _mix(whole * _A + h[k:k + n])
    sets, at = [], 0
    for ws in words:
        if len(ws) >= shingle:
            sets.append(np.unique(whole[at:at + len(ws) - shingle + 1]))
        elif ws:
            sets.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(ws), seed=len(ws))], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += len(ws)
    return sets


def least_overlap(n: int, percent: int) -> int:
    """Tokens that a set of n shares with any partner."""
    return -(-percent * n // 100)


def _sieve_l(n: int, percent: int) -> int:
    return max(1, min(n // SIEVE, least_overlap(n, percent)))


def _groups(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    """The batch's texts, about _TEXTS bytes at a time."""
    group, size = [], 0
    for text in text_bytes(batch.column("text")):
        group.append(text)
        size += len(text)
        if size >= _TEXTS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sieved(shingle: int, percent: int) -> Callable:
    """doc_id, key, n, class (digest), c (its first 64 bits), need, prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, c, need, prefix = [], [], [], [], []
            for group in _groups(batch):
                for s in shingle_sets(group, shingle):
                    digest = xxhash.xxh3_128_digest(s.tobytes())
                    n.append(len(s))
                    cls.append(digest)
                    c.append(int.from_bytes(digest[:8], "big", signed=True))
                    need.append(_sieve_l(least_overlap(len(s), percent), percent))
                    prefix.append(s[:len(s) - least_overlap(len(s), percent) + _sieve_l(len(s), percent)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(c, pa.int64()),
                                              pa.array(need, pa.int64()), _lists(prefix)], ["doc_id", "key", "n", "cls", "c", "need", "prefix"])
    return run


def _ordered(shingle: int, percent: int, frequent: np.ndarray) -> Callable:
    """key, n, shingles, prefix (the longest of LADDER) and s0 to s7 (parities
    of the tokens in 512 bins): frequent tokens last, others by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for group in _groups(batch) for s in shingle_sets(group, shingle)]
            prefixes, bits = [], np.zeros((len(sets), _SIGNATURE), np.uint8)
            for k, s in enumerate(sets):
                t = least_overlap(len(s), percent)
                last = frequent[np.searchsorted(frequent, s).clip(max=len(frequent) - 1)] == s if len(frequent) else np.zeros(len(s), bool)
                prefixes.append(np.concatenate([s[~last], s[last]])[:len(s) - t + min(t, LADDER[-1])])
                bits[k] = np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=_SIGNATURE) & 1
            words = np.packbits(bits, axis=1).view(np.int64) if len(sets) else np.zeros((0, 8), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([len(s) for s in sets], pa.int64()), _lists(sets), _lists(prefixes),
                                              *[pa.array(np.ascontiguousarray(words[:, i])) for i in range(8)]],
                                             ["key", "n", "shingles", "prefix", *(f"s{i}" for i in range(8))])
    return run


def _sieve(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The rows whose prefixes share enough tokens with other classes, and the
    frequent tokens."""
    tokens = rows.select("row", "need", "c", F.explode("prefix").alias("token"))
    met = tokens.groupBy("token").agg(F.min("c").alias("a"), F.max("c").alias("b"), F.count(F.lit(1)).alias("held")).where("a <> b").select("token", "held")
    met = materialize(met, "jaccard-met")
    step = F.floor(F.log2("held")).cast("int")
    least, total = 64, 0
    for s, n in sorted(map(tuple, met.where(F.col("held") >= HEAVY).groupBy(step.alias("s")).agg(F.count(F.lit(1))).collect()), reverse=True):
        total += n
        if total > FREQUENT:
            break
        least = s
    frequent = met.where((F.col("held") >= HEAVY) & (step >= least)).select("token").toArrow()["token"].to_numpy()
    hits = tokens.join(met.select("token"), "token", "left_semi").groupBy("row", "need").agg(F.count(F.lit(1)).alias("hits"))
    return hits.where("hits >= need").select("row"), np.sort(frequent.astype(np.int64).view(np.uint64))


def _small(keys: DataFrame, name: str) -> DataFrame:
    """The written keys, broadcast where their size allows it."""
    written, size = materialize_sized(keys, name)
    return F.broadcast(written) if size <= BROADCAST_BYTES else written


def _may_link(percent: int) -> Column:
    """Fitting sizes, and parities that differ in no more bits than the sets
    may: |a + b| (100 - p) / (100 + p) tokens are in one of the two only."""
    na, nb = F.col("a.n"), F.col("b.n")
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a.s{i}").bitwiseXOR(F.col(f"b.s{i}"))) for i in range(8)])
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * apart <= (100 - percent) * (na + nb))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    pairs = materialize(pairs, "jaccard-pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets.join(_small(nodes, "jaccard-nodes"), "node", "left_semi")  # only the sets that are compared are moved
    one = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("shingles").alias(f"s{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(one("b"), "b").join(one("a"), "a").where(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, l, central, s0 to s7) of the chosen prefixes, of the
    tokens that several classes hold."""
    signature = [f"s{i}" for i in range(8)]
    every = sets.select("node", "n", F.posexplode("prefix").alias("place", "token"))
    size = every.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = materialize(every.join(size, "token"), "jaccard-shared")
    t = F.expr(f"({percent} * n + 99) div 100")
    within = lambda l: F.col("place") < F.col("n") - t + F.least(F.lit(l), t)  # noqa: E731, E741
    read = [F.coalesce(F.sum(F.when(within(l), F.col("c"))), F.lit(0)).alias(f"r{l}") for l in LADDER]  # noqa: E741
    most = shared.groupBy("node", "n").agg(*read)
    cost = F.array_min(F.array(*[F.struct((F.col(f"r{l}") * (1 + F.col("n") / F.lit(float(l)))).alias("cost"), F.lit(l).alias("l")) for l in LADDER]))  # noqa: E741
    chosen = most.select("node", cost["l"].alias("l"))
    kept = shared.join(chosen, "node").where(within(F.col("l"))).select("token", "node", F.least("l", t).alias("l"), (F.col("n") - t + F.col("l")).alias("size"))
    kept = materialize(kept, "jaccard-kept")
    central = kept.groupBy("node").agg((F.count(F.lit(1)) / F.max("size")).alias("central"))
    return materialize(kept.join(central, "node").join(sets.select("node", "n", *signature), "node").select("token", "node", "n", "l", "central", *signature), "jaccard-postings")


def _group_links(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links of each posting list's members to its hub."""
    hub = postings.groupBy("token").agg(F.max(F.struct("central", (-F.col("node")).alias("node"))).alias("hub")).select("token", (-F.col("hub.node")).alias("hub"))
    pairs = postings.join(hub, "token").where("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y")).distinct()
    narrow = sets.drop("shingles", "prefix", "key", "cls")
    pairs = pairs.join(narrow.alias("a"), F.col("x") == F.col("a.node")).join(narrow.alias("b"), F.col("y") == F.col("b.node")).where(_may_link(percent))
    return _verified(pairs.select(F.col("y").alias("a"), F.col("x").alias("b")), sets, percent)


def _join_links(postings: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between nodes of different components."""
    at = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = at.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    at = materialize(at.join(mixed, "token", "left_semi"), "jaccard-mixed")
    a, b = at.alias("a"), at.alias("b")
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root")) & _may_link(percent))
    pairs = met.groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("a.l", "b.l")).alias("l"))
    return _verified(pairs.where("shared >= l").select("a", "b"), sets, percent)


def _nodes(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b)."""
    found = components(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b"))
    return found.unionAll(found.select(F.col("root").alias("node"), "root")).distinct()


def similar_components(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``."""
    keyed = docs.select("doc_id", whole_text().alias("text")).withColumn("key", F.unhex(F.md5("text")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed.select("doc_id", "key", "text").mapInArrow(_sieved(shingle, percent), f"doc_id {id_type}, key binary, n bigint, cls binary, c bigint, need bigint, prefix array<bigint>")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows")
    left, frequent = _sieve(rows.where("n > 0"))
    classes = materialize(rows.where("n > 0").groupBy("cls").agg(F.min("row").alias("node"), F.min("doc_id").alias("first"), F.min("key").alias("key")), "jaccard-classes")
    # All rows of a class pass the sieve or none, so its first row stands for it.
    again = _small(classes.join(left.select(F.col("row").alias("node")), "node", "left_semi").select("key", "node"), "jaccard-left")
    texts = keyed.join(again, "key").groupBy("key", "node").agg(F.first("text").alias("text"))
    signature = ", ".join(f"s{i} bigint" for i in range(8))
    sets = texts.select(F.col("node").alias("key"), "text").mapInArrow(_ordered(shingle, percent, frequent), f"key bigint, n bigint, shingles array<bigint>, prefix array<bigint>, {signature}")
    sets = materialize(sets.withColumnRenamed("key", "node"), "jaccard-sets")
    postings = _postings(sets, percent)
    links = materialize(_group_links(postings, sets, percent), "jaccard-links")
    more = _join_links(postings, materialize(_nodes(links), "jaccard-groups"), sets, percent)
    roots = materialize(_nodes(materialize(links.unionAll(more), "jaccard-links")), "jaccard-roots")
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    owner = named.join(least, "root").select("cls", "component_id")
    found = rows.where("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "cls").join(owner, "cls").drop("cls")
    return found.unionAll(rows.where("n = 0").select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id")))
