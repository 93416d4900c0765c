"""Exact top-k search by distributed histogram selection.

Vectors become integers, floor(1024 * x); scores are integer inner products.
Queries go in blocks of QUERY_BLOCK, broadcast, past all rows. Every pass
scores everything anew and counts, per query, how many scores fall in each of
BINS equal bins of the interval that still holds the kth highest score; the
summed histogram says which bin that is, and the next pass looks into it
alone, until the interval is one integer: the kth score itself. The last pass
returns the scores above it, and of those equal to it the smallest vec_ids
that are still wanted.

What is sent is bounded. From a task, a query needs only the bins that reach
the task's own kth highest score of the interval (the sums below can't hold
the global kth one), so at most k bins; in the last pass at most k rows. The
sums are then grouped per query by Spark. The driver keeps one block's
intervals, three numbers a query.

Cases: vectors that are null, or hold null, NaN or infinite components take
no part; shorter vectors count as padded with zeros; a query's own vec_id is
no candidate, other rows are, repeated ones as often as they occur; repeated
query ids ask once, with the smallest vector; null ids take no part; fewer
candidates than k are all returned; ties go to the smaller vec_id. Scores are
exact as long as they fit 64 bits; a larger one, or a finite component of 2**52
or more, is an error, never a row left out. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.session import materialize

SCALE = 1024
BINS = 512
QUERY_BLOCK = 2048
#: Scores that a task holds at a time.
_CELLS = 1 << 20


def integers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): the usable rows with integer components."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ok)
    whole = lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c * SCALE).cast("long"))
    return usable.select("vec_id", F.transform("x", lambda c: F.coalesce(whole(c), F.raise_error("a vector's component is 2**52 or more").cast("long"))).alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of width, padded with zeros or cut where the
    queries have zeros only."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row, col = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = col < width
    out[row[inside], col[inside]] = values[inside]
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floats where no partial sum can pass
    2**53, by integers where none can pass 2**63, else by Python's integers,
    with an error where a score itself doesn't fit."""
    if q.size == 0 or x.size == 0:
        return np.zeros((len(q), len(x)), np.int64)
    most = q.shape[1] * float(np.abs(q).max()) * float(np.abs(x).max())
    if most < 2.0 ** 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    if most < 2.0 ** 62:
        return q @ x.T
    exact = q.astype(object) @ x.T.astype(object)
    if max(map(abs, exact.ravel())) >= 1 << 63:
        raise OverflowError("a score doesn't fit 64 bits")
    return exact.astype(np.int64)


def _scores(batches: Iterator[pa.RecordBatch], q_ids: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(scores, candidate ids, own): own marks a query's own row."""
    step = max(1, _CELLS // max(1, len(q)))
    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        x = _matrix(batch.column("v"), q.shape[1])
        for k in range(0, len(ids), step):
            part = ids[k:k + step]
            yield _products(q, x[k:k + step]), part, q_ids[:, None] == part[None, :]


def _count_bins(q_ids: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, width: np.ndarray, want: np.ndarray) -> Callable:
    """A task's histograms over [low, high) of each query in bins of width, down
    to the bin of its own ``want``-th highest score there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(q), BINS), np.int64)
        base = (np.arange(len(q)) * BINS)[:, None]
        for s, _, own in _scores(batches, q_ids, q):
            b = (s - low[:, None]) // width[:, None]
            inside = (b >= 0) & (s < high[:, None]) & ~own
            total += np.bincount((base + b)[inside], minlength=total.size).reshape(total.shape)
        above = total[:, ::-1].cumsum(1)[:, ::-1] - total  # in higher bins
        at, b = np.nonzero((total > 0) & (above < want[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[at, b])], ["q", "bin", "n"])
    return run


def _collect_best(q_ids: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int) -> Callable:
    """A task's rows with scores of at least the kth, at most k a query: the
    highest, then those of the smallest ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = pd.DataFrame({"q": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
        for s, ids, own in _scores(batches, q_ids, q):
            at, col = np.nonzero((s >= kth[:, None]) & ~own)
            if len(at):
                best = pd.concat([best, pd.DataFrame({"q": at, "vec_id": ids[col], "score": s[at, col]})])
                best = best.sort_values(["q", "score", "vec_id"], ascending=[True, False, True]).groupby("q").head(k)
        yield pa.RecordBatch.from_arrays([pa.array(q_ids[best["q"]]), pa.array(best["vec_id"].to_numpy(np.int64)), pa.array(best["score"].to_numpy(np.int64))],
                                         ["query_id", "vec_id", "score"])
    return run


def _block(rows: DataFrame, q_ids: np.ndarray, q: np.ndarray, reach: float, k: int) -> DataFrame:
    """The best k of one block of queries."""
    bound = np.ceil(np.sqrt((q.astype(float) ** 2).sum(1)) * reach).astype(np.int64) + 1  # no score is larger
    low, high = -bound, bound + 1
    width = -(-(high - low) // BINS)
    want = np.full(len(q), k, np.int64)  # how many are wanted of the interval
    open_ = np.ones(len(q), bool)
    while open_.any():
        mine = np.nonzero(open_)[0]
        counts = rows.mapInArrow(_count_bins(q_ids[mine], q[mine], low[mine], high[mine], width[mine], want[mine]), "q int, bin int, n bigint")
        hist = np.zeros((len(mine), BINS), np.int64)
        found = counts.groupBy("q", "bin").agg(F.sum("n").alias("n")).toPandas()
        hist[found["q"], found["bin"]] = found["n"]
        upto = hist[:, ::-1].cumsum(1)[:, ::-1]  # in this bin and higher ones
        has = upto >= want[mine][:, None]
        for place, m in enumerate(mine):
            if not has[place].any():  # fewer candidates than k: all are wanted
                open_[m] = False
                continue
            b = int(np.nonzero(has[place])[0][-1])
            want[m] -= int(upto[place, b] - hist[place, b])
            low[m] += b * width[m]
            high[m] = min(high[m], low[m] + width[m])
            open_[m] = width[m] > 1
            width[m] = -(-width[m] // BINS)
    return rows.mapInArrow(_collect_best(q_ids, q, low, k), "query_id bigint, vec_id bigint, score bigint")


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, vector: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates."""
    rows = materialize(integers(candidates, vector), "topk-rows")
    asked = materialize(integers(queries, vector).groupBy("vec_id").agg(F.min("v").alias("v")), "topk-queries")
    size, reach = rows.agg(F.max(F.size("v")), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)))).first()
    out, last = None, None
    while True:  # a block of queries at a time, in order of their ids
        rest = asked if last is None else asked.where(F.col("vec_id") > last)
        part = rest.orderBy("vec_id").limit(block).toPandas()
        if not len(part):
            break
        last = int(part["vec_id"].iloc[-1])
        ids = part["vec_id"].to_numpy(np.int64)
        q = _matrix(pa.array(part["v"].tolist(), pa.list_(pa.int64())), max(1, size or 1))
        best = materialize(_block(rows, ids, q, float(reach or 0.0), k), "topk-best")
        out = best if out is None else out.unionAll(best)
    if out is None:
        out = rows.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return out.select("query_id", place, "vec_id", "score").where(F.col("rank") <= k)
