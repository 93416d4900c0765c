"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word
shingles. Each of the 64 bits gets one of the 15 nonzero vectors of
{0,1}^4; table v (15 of them) keeps the bits whose vector has an odd inner
product with v. Any three bits' vectors span at most three of the four
dimensions, so some v is orthogonal to them all: a pair that differs in at
most three bits agrees on everything that table v keeps. No pair within the
radius can be missed, and a table keeps about 34 bits, so other fingerprints
seldom meet.

Large buckets: equal fingerprints are one node from the start. A bucket of
over BUCKET distinct fingerprints is divided again by the same covering over
the bits that its table doesn't keep (about 30, of which about 14 stay
open), spread over the cluster; what then shares a bucket differs in open
bits only, so it holds at most 2**16 distinct fingerprints whatever the
input. Within a bucket, a task searches from fingerprint to fingerprint and
returns a spanning tree of the links, not the pairs. Components come from
alternating large and small stars over those edges, written between rounds.

Cases: a null text counts as empty; texts without words have fingerprint
zero and link like any other; a null doc_id never becomes a component id
unless all of its component's are null; repeated rows stay repeated rows.
Other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import column_function, text_bytes, whole_text
from airshed.session import discard, materialize

SEED = 42
#: Larger buckets are divided again.
BUCKET = 4096
#: Shingle hashes whose bits are counted at a time.
_CHUNK = 1 << 16


def fingerprint_of(b: bytes, shingle: int) -> int:
    """The SimHash of a text's UTF-8 bytes, unsigned."""
    words = b.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    text = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    lasts = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[s:e], SEED) for s, e in zip(starts[:n].tolist(), lasts.tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        bits = np.unpackbits(h[k:k + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a bigint with the same 64 bits."""
    def make():
        def apply(batch: pa.Array) -> pa.Array:
            return pa.array(np.array([fingerprint_of(b, shingle) for b in text_bytes(batch)], np.uint64).view(np.int64))
        return apply
    return column_function(make, "bigint")(text)


def covering_masks(open_bits: int, radius: int = 3) -> list[int]:
    """2**(radius+1) - 1 masks over the set bits of ``open_bits``: every set
    of at most ``radius`` of those bits lies wholly outside some mask."""
    vectors = 1 << (radius + 1)
    places = [i for i in range(64) if open_bits >> i & 1]
    masks = []
    for v in range(1, vectors):
        masks.append(sum(1 << i for k, i in enumerate(places) if (v & (k % (vectors - 1) + 1)).bit_count() & 1))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _spanning(members: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges of a spanning forest of the links between distinct fingerprints."""
    rest = members
    left, right = [], []
    while len(rest):
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            for x in queue.pop():
                near = np.bitwise_count(rest ^ x) <= radius
                if near.any():
                    found, rest = rest[near], rest[~near]
                    left.append(np.full(len(found), x))
                    right.append(found)
                    queue.append(found)
    return left, right


def _make_edges(radius: int):
    def make():
        def apply(batch: pa.Array) -> pa.Array:
            out = []
            for k in range(len(batch)):
                members = np.unique(batch[k].values.to_numpy(zero_copy_only=False).astype(np.int64)).view(np.uint64)
                left, right = _spanning(members, radius)
                if left:
                    a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
                    out.append([{"a": x, "b": y} for x, y in zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True)])
                else:
                    out.append([])
            return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
        return apply
    return make


def _buckets(fps: DataFrame, radius: int, bucket: int) -> DataFrame:
    """Arrays of distinct fingerprints that share a bucket: of each bucket of
    2 to ``bucket`` members, and of the parts of larger ones."""
    masks = covering_masks((1 << 64) - 1, radius)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keyed.join(sizes, ["t", "key"]), "simhash-buckets")
    small = shared.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("members"))
    # The second covering keeps bits among those that the first left open.
    second = F.array(*[F.array(*[F.lit(_signed(m | s)) for s in covering_masks(~m & ((1 << 64) - 1), radius)]) for m in masks])
    parts = (shared.where(F.col("n") > bucket)
             .select("t", "fp", F.posexplode(F.element_at(second, F.col("t") + 1)).alias("u", "mask"))
             .groupBy("t", "u", F.col("fp").bitwiseAND(F.col("mask")).alias("key")).agg(F.collect_list("fp").alias("members")))
    return small.select("members").unionAll(parts.select("members")).where(F.size("members") > 1)


def links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b), a < b, whose components are those of all links between
    the distinct fingerprints ``fps.fp``."""
    edges = column_function(_make_edges(radius), "array<struct<a:bigint,b:bigint>>")(F.col("members"))
    return _buckets(fps, radius, bucket).select(F.explode(edges).alias("e")).select("e.a", "e.b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the smallest
    node of its component. Alternates large and small stars; every round is
    written, so a lost executor costs one round at most."""
    cur = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "simhash-cc")
    while True:
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.unionAll(low.where("u > m").select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "simhash-cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, cur = cur, materialize(moved.unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v")
                          .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "simhash-cc")
        discard(last)
        discard(large)
        # Done when each node points to one node that points nowhere.
        many = cur.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not many and not cur.join(cur.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").limit(1).count():
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _classes(docs: DataFrame, shingle: int, radius: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) per row, and (fp, root, component_id) per distinct fp."""
    rows = materialize(docs.select("doc_id", fingerprints(whole_text(), shingle).alias("fp")), "simhash-fp")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(fps.select("fp"), radius, bucket))
    nodes = roots.unionAll(roots.select(F.col("root").alias("node"), "root")).distinct()
    linked = materialize(fps.join(nodes, fps.fp == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, linked.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row of ``docs``."""
    rows, owner = _classes(docs, shingle, radius, bucket)
    return rows.join(owner, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, shingle: int = 3, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """One document per component: the one with the smallest doc_id, all
    columns; of rows that repeat that doc_id in the component, the smallest
    row. An id with unlike texts keeps one row in each component whose smallest
    id it is. Of a component whose rows all lack a doc_id, the smallest row
    stays."""
    rows, owner = _classes(docs, shingle, radius, bucket)
    owner = materialize(owner, "simhash-owner")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    back = [F.col(f"r.`{c}`").alias(c) for c in docs.columns]
    first = owner.where("component_id is not null").select(F.col("component_id").alias("doc_id")).distinct()
    spread = rows.where("doc_id is not null").join(owner, "fp").groupBy("doc_id").agg(F.min("root").alias("a"), F.max("root").alias("b"))
    mixed = materialize(spread.where("a != b").select("doc_id"), "simhash-mixed")
    kept = docs.join(first.join(mixed, "doc_id", "left_anti"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("r"))
    # Rows without an id, and those of ids with unlike texts, find their component by their fingerprint.
    some = docs.join(mixed, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
    some = some.select(F.col("doc_id").alias("id"), fingerprints(whole_text(), shingle).alias("fp"), row.alias("r"))
    some = some.join(owner, "fp").where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("r").alias("r"))
    return kept.select(*back).unionAll(some.select(*back))
