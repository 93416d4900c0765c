"""Ranked lexical search over a length-stratified index.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased. With N documents that hold a term, L terms in all, n terms in a
document, df documents that hold a term and tf its occurrences in a document:
a term weighs w = floor(1000 ln((2N+2) / (2df+1))), a document's normaliser is
m = 10 + (90 n N) div L, and its score for a query is the sum over the query's
distinct terms of w * ((10^9 tf) div (1000 tf + 8 m)).

Index: documents of equal m form a stratum. Sorted by length, they are cut
into segments of one stratum each, at most SEGMENT documents and about
POSTINGS postings; a term's postings in a segment stand by falling tf, so the
first gives the segment's largest impact of the term. Within a segment an
impact depends on tf alone and is computed once per distinct tf. The index is
a table (m, ids, terms, counts, places, tfs), a row per segment, that holds
every document and every term.

Search: a segment's bound for a query is the sum of w times the largest
impacts of the query's terms. A first round visits, of the segments that a
task has at hand, the one with the highest bound; the k-th best score found
is a floor for the true one. The second round visits segments by falling
bound and leaves out those whose bound is under the floor or under the task's
own k-th score, so nothing that could enter the result is left out. Queries
go in blocks of BLOCK terms against all segments; a task returns at most k
rows a query.

Cases: null texts and texts without terms aren't documents; a query of
unknown terms or none has no rows; rows of one item_id are one query; rows
that repeat a doc_id are documents each; equal scores by doc_id, null last;
an empty table gives no rows; texts are whole; other columns aren't read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm.common import column_function, text_bytes
from airshed.session import materialize

SEGMENT, POSTINGS = 1024, 1 << 17
#: Rows of a batch, documents or segments.
BATCH_ROWS = 32
#: Query terms of a block, counted once per query.
BLOCK = 50_000

#: How a segment holds places and frequencies.
_PLACE, _TF = np.dtype("<u2"), np.dtype("<i4")

_UPPER = range(65, 91)
#: Separators as blanks, A-Z lower-cased.
_FOLD = bytes(b + 32 if b in _UPPER else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


#: What terms consist of.
_TERM_CHARACTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


# ----------------------------------------------------------------- the index
def term_count(text: Column) -> Column:
    """The number of terms of a text, with repeats."""
    def make():
        return lambda batch: pa.array([len(terms_of(b)) for b in text_bytes(batch)], pa.int64())
    return column_function(make, "bigint")(text)


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, text and n of the rows that hold a term. Which rows do is asked
    in the JVM: a condition on n would be moved below it and count every text
    again, in a second Python worker beside the first."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where(F.col("text").rlike(_TERM_CHARACTER)).withColumn("n", term_count(F.col("text")))


class _Open:
    """A segment that documents of stratum m are added to: a code per term,
    and codes and frequencies per document."""

    def __init__(self, m: int):
        self.m, self.tokens, self.ids, self.codes, self.tfs, self.code = m, 0, [], [], [], {}

    def add(self, doc_id: int | None, text: bytes) -> None:
        count = Counter(terms_of(text))
        code = self.code
        self.codes.append(np.fromiter((code.setdefault(t, len(code)) for t in count), np.int32, len(count)))
        self.tfs.append(np.fromiter(count.values(), _TF, len(count)))
        self.ids.append(doc_id)
        self.tokens += len(count)

    def row(self) -> pa.RecordBatch:
        codes, tf = np.concatenate(self.codes), np.concatenate(self.tfs)
        place = np.repeat(np.arange(len(self.ids)).astype(_PLACE), [len(c) for c in self.codes])
        order = np.lexsort((place, -tf, codes))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        counts = np.bincount(codes, minlength=len(self.code)).astype(_TF)
        return pa.RecordBatch.from_arrays([pa.array([self.m], pa.int64()), one(pa.array(self.ids, pa.int64())),
                                           *[pa.array([x], pa.binary()) for x in (b"\n".join(self.code), counts.tobytes(), place[order].tobytes(), tf[order].tobytes())]],
                                          ["m", "ids", "terms", "counts", "places", "tfs"])


def _segments(segment: int) -> Callable:
    """Segments of at most ``segment`` documents that come by rising m."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: _Open | None = None
        for batch in batches:
            for i, m, text in zip(batch.column("doc_id").to_pylist(), batch.column("m").to_pylist(), text_bytes(batch.column("text")), strict=True):
                if part and (m != part.m or len(part.ids) >= segment or part.tokens >= POSTINGS):
                    yield part.row()
                    part = None
                part = part or _Open(m)
                part.add(i, text)
        if part:
            yield part.row()
    return run


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few rows inside: documents sorted by length put the
    longest texts side by side, and a row of the index is a whole segment."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {k: spark.conf.get(k) for k in names}
    for k in names:
        spark.conf.set(k, str(BATCH_ROWS))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@dataclass
class Index:
    segments: DataFrame  # m, ids, terms, counts, places, tfs
    documents: int  # N
    terms: int  # L


def build_index(docs: DataFrame, segment: int = SEGMENT) -> Index:
    """The index of all texts of ``docs`` (doc_id, text), written."""
    texts = counted(docs)
    n_docs, n_terms = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"10 + (90 * n * {n_docs}L) div {max(1, n_terms)}L").alias("m")
    # By length, and by row within it: a length that many documents have is divided.
    ordered = texts.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("n", "row").sortWithinPartitions("n", "row").select("doc_id", m, "text")
    made = ordered.mapInArrow(_segments(min(segment, 1 << 16)), "m bigint, ids array<bigint>, terms binary, counts binary, places binary, tfs binary")
    with _small_batches(docs.sparkSession):
        return Index(materialize(made, "lexical-index"), int(n_docs), int(n_terms))


# ---------------------------------------------------------------- the search
@dataclass
class Block:
    """Queries by place: their terms as places in ``terms``."""
    terms: pa.Array
    weights: np.ndarray
    members: np.ndarray  # places of the terms of query 0, then of 1, ...
    starts: np.ndarray
    floors: np.ndarray

    @property
    def size(self) -> int:
        return len(self.starts) - 1


def _terms(batch: pa.RecordBatch, row: int) -> pa.Array:
    return pa.array(batch.column("terms")[row].as_py().split(b"\n"), pa.binary())


def _numbers(batch: pa.RecordBatch, row: int, column: str, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), kind)


class _Segment:
    """A segment as a block of queries sees it."""

    def __init__(self, block: Block, row: int, batch: pa.RecordBatch):
        self.block, self.ids, m = block, batch.column("ids").slice(row, 1).flatten(), batch.column("m")[row].as_py()
        ends = np.concatenate([[0], np.cumsum(_numbers(batch, row, "counts", _TF), dtype=np.int64)])
        self.places, self.tfs = _numbers(batch, row, "places", _PLACE), _numbers(batch, row, "tfs", _TF)
        at = pc.index_in(block.terms, value_set=_terms(batch, row)).fill_null(-1).to_numpy(zero_copy_only=False)
        self.here = at >= 0
        self.start, self.end = np.where(self.here, ends[at], 0), np.where(self.here, ends[at + 1], 0)
        distinct = np.flatnonzero(np.bincount(self.tfs))
        self.impact = np.zeros(int(distinct[-1]) + 1, np.int64)
        self.impact[distinct] = (1_000_000_000 * distinct) // (1000 * distinct + 8 * m)
        most = np.where(self.here, self.impact[self.tfs[np.minimum(self.start, len(self.tfs) - 1)]], 0) * block.weights
        self.bounds = np.add.reduceat(most[block.members], block.starts[:-1])

    def scores(self, query: int) -> np.ndarray:
        total, b = np.zeros(len(self.ids), np.int64), self.block
        for t in b.members[b.starts[query]:b.starts[query + 1]]:
            if self.here[t]:
                s, e = self.start[t], self.end[t]
                total[self.places[s:e]] += b.weights[t] * self.impact[self.tfs[s:e]]
        return total


class _Best:
    """The k best of each query so far, equal scores by id, null last."""

    def __init__(self, block: Block, k: int):
        self.k, self.found = k, [[] for _ in range(block.size)]
        self.floors = block.floors.copy()

    def add(self, query: int, segment: _Segment) -> None:
        scores = segment.scores(query)
        hits = np.nonzero(scores >= max(1, self.floors[query]))[0]
        if len(hits) > self.k:
            least = np.partition(scores[hits], len(hits) - self.k)[len(hits) - self.k]
            hits = hits[scores[hits] >= least]
        if len(hits):
            ids = segment.ids.take(pa.array(hits)).to_pylist()
            rows = self.found[query] + [(-s, i is None, i or 0) for s, i in zip(scores[hits].tolist(), ids, strict=True)]
            self.found[query] = rows = sorted(rows)[:self.k]
            if len(rows) == self.k:
                self.floors[query] = max(self.floors[query], -rows[-1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [(q, None if null else i, -s) for q, rows in enumerate(self.found) for s, null, i in rows]
        q, i, s = zip(*flat) if flat else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, pa.int64()), pa.array(s, pa.int64())], ["query", "doc_id", "score"])


def _visits(block: Block, k: int, probe: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(block, k)
        for batch in batches:
            segments = [_Segment(block, r, batch) for r in range(batch.num_rows)]
            if not segments:
                continue
            bounds = np.stack([s.bounds for s in segments])
            order = np.argsort(-bounds, axis=0, kind="stable")
            for query in range(block.size):
                for r in order[:1 if probe else None, query]:
                    if bounds[r, query] < max(1, best.floors[query]):
                        break
                    best.add(query, segments[r])
        yield best.rows()
    return run


def _document_counts(terms: pa.Array) -> Callable:
    """(place, n): the documents that hold each of the terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                at = pc.index_in(terms, value_set=_terms(batch, row)).fill_null(-1).to_numpy(zero_copy_only=False)
                total += np.where(at >= 0, _numbers(batch, row, "counts", _TF)[at], 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(terms), dtype=np.int32)), pa.array(total)], ["place", "n"])
    return run


def _weights(terms: pa.Array, index: Index) -> np.ndarray:
    df = np.zeros(len(terms), np.int64)
    counts = index.segments.select("terms", "counts").mapInArrow(_document_counts(terms), "place int, n bigint")
    for place, n in counts.groupBy("place").agg(F.sum("n")).collect():  # a row per term of the block
        df[place] = n
    return np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def _blocks(queries: DataFrame, index: Index) -> Iterator[tuple[list, Block]]:
    """Blocks of whole queries, about BLOCK distinct terms of each counted."""
    def make():
        return lambda batch: pa.array([[t.decode() for t in dict.fromkeys(terms_of(b))] for b in text_bytes(batch)], pa.list_(pa.string()))
    terms = column_function(make, "array<string>")(F.col("text").cast("string"))
    asked = queries.select("item_id", F.explode(terms).alias("term"))
    asked = materialize(asked.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).orderBy("item_id"), "lexical-queries")

    def block(rows: list) -> tuple[list, Block]:
        place: dict[str, int] = {}
        members = np.array([place.setdefault(t, len(place)) for r in rows for t in r["terms"]], np.int64)
        starts = np.concatenate([[0], np.cumsum([len(r["terms"]) for r in rows])])
        names = pa.array([t.encode() for t in place], pa.binary())
        return [r["item_id"] for r in rows], Block(names, _weights(names, index), members, starts, np.zeros(len(rows), np.int64))
    held, size = [], 0
    for r in asked.toLocalIterator():
        held.append(r)
        size += len(r["terms"])
        if size >= BLOCK:
            yield block(held)
            held, size = [], 0
    if held:
        yield block(held)


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each query's k best documents
    with a score above 0."""
    spark = queries.sparkSession
    found = None
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    with _small_batches(spark):
        for items, block in _blocks(queries, index):
            run = lambda probe: index.segments.mapInArrow(_visits(block, k, probe), "query int, doc_id bigint, score bigint")  # noqa: B023, E731
            ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            for r in ranked(run(True)).where(F.col("rank") == k).collect():  # a row per query of the block at most
                block.floors[r["query"]] = r["score"]
            names = spark.createDataFrame(list(enumerate(items)), f"query int, item_id {queries.schema['item_id'].dataType.simpleString()}")
            best = materialize(ranked(run(False)).join(names, "query").select("item_id", "rank", "doc_id", "score"), "lexical-found")
            found = best if found is None else found.unionAll(best)
    if found is None:
        found = queries.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    return found


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: The contract's rows for ``benchmark`` against ``documents``.
SQL = f"""
WITH listed AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
document AS (SELECT row, doc_id, len(terms) AS n FROM listed WHERE len(terms) > 0),
posting AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM listed) GROUP BY ALL),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM document),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM posting, whole GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
normal AS (SELECT row, doc_id, 10 + (90 * n * n_docs) // n_terms AS m FROM document, whole),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM asked JOIN weight USING (term) JOIN posting USING (term) JOIN normal USING (row) GROUP BY item_id, row, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""
