"""Aggregation, collapse and de-duplication.

"First" always means first in file order, carried as an explicit ordinal
column (``_ord``): Spark's ``first`` and ``dropDuplicates`` have no order.
Everything is an aggregation (``min_by`` on the ordinal), not a window, so
partial aggregation combines a hot key on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import CONCAT_SEP
from airshed.operators.impute import exact_means

ORD = "_ord"


def first_non_null(c: str, order: str = ORD):
    """Value of ``c`` on the earliest row where it is not null."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))


# A2
def agg_distinct_concat(df: DataFrame, keys: list[str], cols: list[str], order: str = ORD,
                        sep: str = CONCAT_SEP) -> DataFrame:
    """Per key, join the distinct non-null values of each column with
    ``sep`` in order of first appearance; no value -> ''.

    Long form (key, column, value) -> min ordinal per distinct value (partial
    aggregation) -> one ordered list per key and column; only distinct values
    are ever collected."""
    long = df.select(*keys, F.col(order).alias("__o"),
                     F.inline(F.array(*[F.struct(F.lit(c).alias("__c"),
                                                 F.col(c).cast("string").alias("__v"))
                                        for c in cols])))
    # Null values stay in the first aggregation (so a key with only nulls
    # still yields '') and are skipped when the list is collected.
    firsts = long.groupBy(*keys, "__c", "__v").agg(F.min("__o").alias("__o"))
    lists = (firsts.groupBy(*keys, "__c")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(
                 F.when(F.col("__v").isNotNull(), F.struct("__o", "__v")))), lambda s: s["__v"]), sep)
                  .alias("__s")))
    wide = lists.groupBy(*keys).pivot("__c", cols).agg(F.first("__s"))
    return wide.select(*keys, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])


# A1
def agg_mean_first_concat(df: DataFrame, keys: list[str], mean_cols: list[str],
                          first_cols: list[str], concat_cols: list[str],
                          order: str = ORD) -> DataFrame:
    """Group by ``keys`` (null keys dropped): mean of ``mean_cols``, first
    non-null of ``first_cols``, ordered distinct concat of ``concat_cols``."""
    base = df.dropna(subset=keys)
    sums, means = exact_means(mean_cols)
    firsts = [first_non_null(c, order).alias(c) for c in first_cols]
    main = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *firsts, *sums).select(*keys, *means, *first_cols)
    if not concat_cols:
        return main
    cat = agg_distinct_concat(base, keys, concat_cols, order)
    out = main.join(cat, on=keys, how="left")
    return out.select(*keys, *mean_cols, *first_cols,
                      *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in concat_cols])


# A3
def collapse_duplicates(df: DataFrame, keys: list[str], mean_cols: list[str],
                        first_cols: list[str], order: str = ORD,
                        first_default: str | None = "") -> DataFrame:
    """One row per key: mean of the numeric columns, first non-null of the
    text columns. Aggregating unique keys is the identity on the listed
    columns, so it is always applied (no data-dependent branch)."""
    firsts = [first_non_null(c, order) for c in first_cols]
    if first_default is not None:
        firsts = [F.coalesce(f, F.lit(first_default)) for f in firsts]
    sums, means = exact_means(mean_cols)
    one = df.groupBy(*keys).agg(*[f.alias(c) for f, c in zip(firsts, first_cols)], F.min(order).alias(order), *sums)
    return one.select(*keys, *means, *first_cols, order)


# A4
def count_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows in a key group of size > 1, and surplus rows (total
    minus distinct keys). Null keys compare equal, as in pandas."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.agg(
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).cast("bigint").alias("n_in_duplicate_groups"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("n_surplus"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_rows"))


# What a key's earliest ordinal may start with to be sieved by: types that a
# hash aggregation holds.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType)
# A sieve whose written size is at most this is broadcast; with a larger one
# the rows stay as they are.
SIEVE_BYTES = 32 << 20


def sieve_first(df: DataFrame, keys: list[str], order: str = ORD) -> DataFrame:
    """The rows of ``df`` but for some that A5 doesn't keep: a row stays where
    the leading number of its ordinal is the least of its key (nulls first).

    One hash aggregation of two numbers over the keys, then a semi-join with a
    64-bit hash of key and number (rows of equal hashes stay too). A5 sorts whole rows,
    as a smallest row is no number, and so sorts a few a key in place of all."""
    from airshed.session import materialize_sized
    lead, dtype = F.col(order), df.schema[order].dataType
    if isinstance(dtype, T.StructType) and dtype.fields:
        lead, dtype = lead[dtype.fields[0].name], dtype.fields[0].dataType
    if not isinstance(dtype, WHOLE):
        return df
    least = df.groupBy(*keys).agg(F.min(lead).alias("__least"), F.max(lead.isNull()).alias("__none"))
    mark = lambda x: F.xxhash64(*[F.col(f"`{k}`") for k in keys], x, x.isNull())
    marks, size = materialize_sized(least.select(mark(F.when(~F.col("__none"), F.col("__least"))).alias("__mark")), "sieve")
    if size > SIEVE_BYTES:
        return df
    return df.withColumn("__mark", mark(lead)).join(F.broadcast(marks), "__mark", "left_semi").drop("__mark")


# A5
def dedupe_keep_first(df: DataFrame, keys: list[str], order: str = ORD) -> DataFrame:
    """Keep the earliest row per key; null keys compare equal. Rows that tie
    on ``order`` (any orderable type, an integer or a struct) are told apart
    by their other columns, so exactly one row stays whatever the input's
    partitioning. One aggregation: a hot key is one row per task before the
    shuffle."""
    rest = [c for c in df.columns if c not in keys and c != order]
    row = F.struct(*[F.col(f"`{c}`") for c in ([] if order in keys else [order]) + rest])
    picked = df.groupBy(*keys).agg(F.min(row).alias("__row"))
    return picked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`").alias(c)
                           for c in df.columns])


def dedupe_keep_first_window(df: DataFrame, keys: list[str], order: str = ORD) -> DataFrame:
    """Window form of A5 (one key group per task); kept as a cross-check."""
    from pyspark.sql import Window
    ties = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in keys and c != order]
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first(), *ties)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
