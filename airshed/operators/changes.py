"""Keys, upserts and change detection.

Spark tables do not enforce keys and Parquet refuses ``MERGE``; an upsert is
therefore a pure plan (anti join + union). The table store applies it to the
parts of the target that a batch touches (``airshed.sources.tables``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed import functions as fx


class DuplicateKeyError(ValueError):
    """A batch holds two rows for one conflict key (PostgreSQL refuses the
    statement; so do we, D5)."""


# J9
def check_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row (must be empty)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def require_unique(df: DataFrame, keys: list[str], what: str = "table") -> DataFrame:
    """Raise DuplicateKeyError if ``keys`` repeat (run it on a written
    version before publishing it; it reads the key columns only)."""
    from airshed.session import shuffles_go
    with shuffles_go(df.sparkSession):
        unique = check_unique_key(df.select(*keys), keys).isEmpty()
    if not unique:
        raise DuplicateKeyError(f"{what} has several rows for one key {keys}")
    return df


# J8
def check_foreign_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose ``key`` has no row in ``dim`` (must be empty)."""
    return fact.join(dim.select(key).distinct(), on=key, how="left_anti")


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _prepare_batch(batch: DataFrame, keys: list[str], on_duplicate: str,
                   order: str | None) -> DataFrame:
    if on_duplicate == "error":
        dup = check_unique_key(batch, keys)
        if not dup.isEmpty():
            raise DuplicateKeyError(f"batch has several rows for one key {keys}")
        return batch
    if on_duplicate == "first":
        from airshed.operators.dedupe import dedupe_keep_first
        if order is None:
            raise ValueError("on_duplicate='first' needs an order column")
        return dedupe_keep_first(batch, keys, order)
    if on_duplicate in ("trust", "defer"):
        # "defer": the caller validates the written result (require_unique)
        # before publishing it, instead of evaluating the batch twice.
        return batch
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


# U1
def upsert_by_key(target: DataFrame, batch: DataFrame, keys: list[str],
                  on_duplicate: str = "error", order: str | None = None) -> DataFrame:
    """Insert-or-replace by key: target rows whose key is in the batch are
    replaced by the batch row; the rest stay. Plain equality: a null key
    matches nothing and is always inserted (as a PostgreSQL unique key)."""
    batch = _prepare_batch(batch, keys, on_duplicate, order)
    kept = target.join(batch.select(*keys).dropna(), on=keys, how="left_anti")
    return kept.unionByName(batch.select(*target.columns))


# U2
def changed_rows(target: DataFrame, batch: DataFrame, keys: list[str],
                 hash_col: str = "row_hash") -> DataFrame:
    """Batch rows that are new or whose hash differs (null-safe)."""
    t = target.select(*keys, hash_col)
    return batch.join(t, on=_null_safe_on(batch, t, keys + [hash_col]), how="left_anti")


def upsert_changed_only(target: DataFrame, batch: DataFrame, keys: list[str],
                        hash_col: str = "row_hash", on_duplicate: str = "error",
                        order: str | None = None) -> DataFrame:
    """As U1, but a target row is only rewritten when the batch row's hash
    is distinct from it; unchanged rows keep their old values (and audit
    time). One full outer join on the keys: either side is read once, and
    the hashes are compared in the joined row. A null key matches nothing,
    as in U1."""
    batch = _prepare_batch(batch, keys, on_duplicate, order)
    t = target.select(F.lit(True).alias("__in_t"), *[F.col(f"`{c}`").alias(f"__t_{c}") for c in target.columns])
    b = batch.select(F.lit(True).alias("__in_b"), *[F.col(f"`{c}`").alias(f"__b_{c}") for c in target.columns])
    both = t.join(b, reduce(lambda x, y: x & y, [F.col(f"__t_{k}") == F.col(f"__b_{k}") for k in keys]), "full_outer")
    same = F.col(f"__t_{hash_col}").eqNullSafe(F.col(f"__b_{hash_col}"))
    new = F.col("__in_b").isNotNull() & (F.col("__in_t").isNull() | ~same)
    return both.select(*[F.when(new, F.col(f"__b_{c}")).otherwise(F.col(f"__t_{c}")).alias(c) for c in target.columns])


# W5
def assign_surrogate_key(df: DataFrame, id_col: str, order_cols: list, start=1) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` in the order of ``order_cols``.

    No single-task global window: the rows are range-partitioned by the
    order and written once with their partition and place; the counts and
    the numbered rows are both read from that one layout (a second
    evaluation would sample other range bounds). Rows are shifted by the
    running total of the earlier partitions' counts (a table with one row
    per partition). ``order_cols`` must make the order total for stable ids."""
    from airshed.session import materialize
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]
    ranked = df.orderBy(*order).withColumn("__pid", F.spark_partition_id())
    ranked = materialize(ranked.withColumn("__mid", F.monotonically_increasing_id()), "surrogate")
    counts = ranked.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__m0"))
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)))
    # One row per partition: bounded by the partition count, so broadcast.
    start_col = start if not isinstance(start, (int, float)) else F.lit(start)
    out = ranked.join(F.broadcast(offsets.select("__pid", "__off", "__m0")), "__pid")
    out = out.withColumn(id_col, (start_col + F.col("__off") + F.col("__mid") - F.col("__m0")).cast("int"))
    return out.drop("__pid", "__mid", "__off", "__m0")


# U3
def insert_if_absent(target: DataFrame, candidates: DataFrame, natural_key: list[str],
                     id_col: str | None = None) -> DataFrame:
    """Add candidate rows whose natural key (null-safe) is not in the
    target; new rows get ids after the target's largest id."""
    cand = candidates.select(*natural_key).distinct()
    t = target.select(*natural_key)
    new = cand.join(t, on=_null_safe_on(cand, t, natural_key), how="left_anti")
    if id_col is None:
        return target.unionByName(new.select(*target.columns))
    base = target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__base"))
    new = attach_scalar(new, base)
    new = assign_surrogate_key(new, id_col, natural_key, start=F.col("__base") + 1).drop("__base")
    return target.unionByName(new.select(*target.columns))


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate (global max, mean, std...) to
    every row as literals. The aggregate runs once (one bounded row reaches
    the driver); no join, so no nested-loop join in the plan."""
    schema = one_row.schema
    js = one_row.select(F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]))).first()
    value = F.from_json(F.lit(js[0] if js is not None else None), schema)  # a constant, folded once
    return df.withColumns({f.name: value[f.name] for f in schema.fields})


# U4 / U5
def union_distinct(frames: list[DataFrame]) -> DataFrame:
    """Set union by column name; a frame lacking a column is padded with
    typed nulls (U5)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.distinct()


# U7
#: Parts of a table by a hash of its key.
BUCKETS = 64


def bucket_digests(df: DataFrame, keys: list[str], cols: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n_rows, digest) of each part of the table that has rows. A
    digest is the sum of a 60-bit value of each row's md5: it changes when a
    row is duplicated (unlike a XOR) and is the same for any row order."""
    cols = cols or [c for c in df.columns if c != "updated_at"]
    return df.groupBy(fx.key_bucket(df, keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(fx.fingerprint_value(df, cols)).cast("decimal(38,0)").cast("string").alias("digest"))


def digest_of_buckets(parts: DataFrame) -> DataFrame:
    """One row (n_rows, digest) over the digests of all parts."""
    lines = F.transform(F.sort_array(F.collect_list(F.struct("bucket", "n_rows", "digest"))),  # a row per bucket
                        lambda r: F.concat_ws(":", r["bucket"].cast("string"), r["n_rows"].cast("string"), r["digest"]))
    return parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"), F.md5(F.array_join(lines, ",")).alias("digest"))


def dataset_fingerprint(df: DataFrame, cols: list[str] | None = None, keys: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """One row (n_rows, digest): order-free digest of a whole dataset in two
    levels, a digest per bucket of ``keys`` (default: all columns) and one
    over those."""
    cols = cols or [c for c in df.columns if c != "updated_at"]
    return digest_of_buckets(bucket_digests(df, keys or cols, cols, buckets))


# U8
def changed_buckets(before: DataFrame, now: DataFrame) -> list[int]:
    """The buckets of ``now`` whose rows differ from ``before``'s (both are
    results of ``bucket_digests``), and those that only ``before`` has."""
    diff = now.select("bucket", "n_rows", "digest").exceptAll(before.select("bucket", "n_rows", "digest"))
    gone = before.join(now, "bucket", "left_anti")
    return sorted(r["bucket"] for r in diff.select("bucket").union(gone.select("bucket")).distinct().collect())  # a row per bucket at most
