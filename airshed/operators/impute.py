"""Gap filling.

Hierarchical group-mean imputation comes in two plan shapes with equal
results:

* ``method="cells"`` (default): aggregate once to the finest cell of all
  levels (sums, value and null counts, a row per cell and column; map-side
  partial aggregation, so a hot key is combined before the shuffle), run the whole
  chain of levels on that small cell table, and join the final fill back to
  the rows once. The wide rows cross the network once whatever the number
  of levels.
* ``method="window"``: ``coalesce(c, avg(c) over (partition by keys))`` per
  level. One whole group per task; kept as the readable cross-check.

A level fills a null only where all of that level's keys are non-null; rows
with a null key keep their observed values (D8).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed import functions as fx

Level = list[str]


def _all_not_null(keys: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


# I1 -- window form
def impute_group_mean_window(df: DataFrame, cols: list[str], keys: Level) -> DataFrame:
    """One level as a whole-partition window mean (W1). Rows with a null key
    keep their values and don't enter the window: they may be many."""
    w = Window.partitionBy(*keys)
    ok = _all_not_null(keys)
    filled = df.filter(ok).withColumns({c: F.coalesce(F.col(c), fx.exact_mean(c, w)) for c in cols})
    return filled.unionByName(df.filter(~ok))


# W1
SALTS = 16


def group_transform(df: DataFrame, keys: Level, outs: dict[str, tuple[str, str]], salts: int = SALTS) -> DataFrame:
    """``df`` with a group value on every row: ``outs`` maps a new column to
    (mean, min, max or count, column). Null keys form groups as other values.

    Two stages over a salted key: each (key, salt) is aggregated, then each
    key; the result goes back to the rows by a join on key and salt. So the
    rows of one group are spread over ``salts`` tasks at either end, however
    many rows it holds. Means are sums of integers (``fx.exact_sum``)."""
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
    first, second = [], []
    for i, (fn, c) in enumerate(outs.values()):
        if fn == "mean":
            first += [F.sum(x).alias(f"__{i}_{j}") for j, x in enumerate(fx.limbs(c))] + [F.count(c).alias(f"__{i}_n")]
            second.append(F.try_divide(fx.from_limbs([F.sum(f"__{i}_{j}") for j in range(5)]), F.sum(f"__{i}_n")))
        else:
            first.append({"min": F.min, "max": F.max, "count": F.count}[fn](c).alias(f"__{i}"))
            second.append({"min": F.min, "max": F.max, "count": F.sum}[fn](f"__{i}"))
    parts = salted.groupBy(*keys, "__salt").agg(*first)
    whole = parts.groupBy(*keys).agg(*[x.alias(o) for x, o in zip(second, outs)])
    spread = whole.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *outs, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__s"))
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return salted.join(spread, match & (F.col("__salt") == F.col("__s"))).select(*df.columns, *outs)


def impute_chain_window(df: DataFrame, cols: list[str], levels: list[Level]) -> DataFrame:
    """Levels in order; each level's mean includes the fills of earlier ones."""
    out = df
    for keys in levels:
        out = impute_group_mean_window(out, cols, keys)
    return out


# I1 -- cell-table form
# A fill table whose written size is at most this is broadcast; a larger one
# is joined back with a shuffle join.
BROADCAST_FILL_BYTES = 32 << 20

Spec = tuple[list[str], list[Level]]


def long_sums(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, __c, __s0 to __s4, __n, __m, __w): per key and column (its place
    in ``cols``) the sums of limbs, the number of values and of nulls, and the
    sum of what limbs can't take. A row per column, not a set of columns for
    each: the generated code is the same for any number of columns."""
    value = F.inline(F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c).cast("double").alias("__x")) for i, c in enumerate(cols)]))
    x = F.col("__x")
    zero = F.lit(0).cast("bigint")
    return df.select(*keys, value).groupBy(*keys, "__c").agg(
        *[F.coalesce(F.sum(part), zero).alias(f"__s{j}") for j, part in enumerate(fx.limbs("__x"))], F.count("__x").alias("__n"),
        F.sum(F.when(x.isNull(), 1).otherwise(0)).alias("__m"), F.sum(F.when(~(F.abs(x) < F.lit(2.0 ** 60)), x)).alias("__w"))


def exact_means(cols: list[str]) -> tuple[list, list]:
    """The aggregates that the order-free means of columns need, and the means
    over the aggregated row (null without values). For a grouping that takes
    its other aggregates too: one shuffle with a row per key, and no join."""
    sums = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        sums += [F.sum(part).alias(f"__{i}_s{j}") for j, part in enumerate(fx.limbs(x))]
        sums += [F.count(x).alias(f"__{i}_n"), F.sum(F.when(~(F.abs(x) < F.lit(2.0 ** 60)), x)).alias(f"__{i}_w")]
    zero = F.lit(0).cast("bigint")

    def mean(i: int):
        total = fx.from_limbs([F.coalesce(F.col(f"__{i}_s{j}"), zero) for j in range(5)]) + F.coalesce(f"__{i}_w", F.lit(0.0))
        return F.try_divide(total, F.col(f"__{i}_n"))
    return sums, [mean(i).alias(c) for i, c in enumerate(cols)]


def _passes(specs: list[Spec]) -> list[tuple[Level, list[str]]]:
    """(keys, columns) in an order that keeps each chain's own; a level that
    several chains have is one pass for the columns of all of them."""
    left = [(cols, list(levels)) for cols, levels in specs]
    out = []
    while any(levels for _, levels in left):
        heads = [levels[0] for _, levels in left if levels]
        keys = next((h for h in heads if not any(h in levels[1:] for _, levels in left)), heads[0])
        out.append((keys, [c for cols, levels in left if levels and levels[0] == keys for c in cols]))
        left = [(cols, levels[1:] if levels and levels[0] == keys else levels) for cols, levels in left]
    return out


def _level_mean(total, f, m):
    """Mean of a level as the rows see it: observed values plus the fills that
    earlier levels gave to a cell's nulls. Sums of integers, so any plan shape
    gives the same bits. ``total`` sums a column over the level."""
    sums = [total(F.col(f"__s{j}") + F.coalesce(x * m, F.lit(0).cast("bigint"))) for j, x in enumerate(fx.limbs(f))]
    den = total(F.col("__n") + F.when(f.isNotNull(), m).otherwise(0))
    return F.try_divide(fx.from_limbs(sums) + F.coalesce(total(F.col("__w")), F.lit(0.0)), den)


def impute_many_cells(df: DataFrame, specs: list[Spec], by: Level | None = None) -> DataFrame:
    """Several independent chains (disjoint column sets) over one cell table:
    the rows are read once for the cell aggregate and once for the join
    back, whatever the number of chains and levels.

    ``by``: for input with about a row per finest cell, where an aggregation
    before the shuffle combines nothing and the cells are as many as the rows.
    The rows' columns cross the network once, by these keys; cells and levels
    that hold them all are then computed in place, and each other level is
    aggregated to its few keys and brought back to the cells. The result is
    the same."""
    from airshed.session import materialize_sized

    finest: list[str] = []
    for _, levels in specs:
        for keys in levels:
            for k in keys:
                if k not in finest:
                    finest.append(k)
    cols = [c for cs, _ in specs for c in cs]
    own = lambda cs: F.col("__c").isin([cols.index(c) for c in cs])
    rows = df.select(*finest, *cols).repartition(*by) if by else df
    cells = long_sums(rows, finest, cols).withColumn("__f", F.lit(None).cast("double"))
    f, m = F.col("__f"), F.col("__m")
    passes = _passes(specs)

    # Each level is a window over the (small) cell table, so a chain adds one
    # exchange per level on cells (none with ``by``) and never re-plans earlier levels.
    while passes and (not by or set(by) <= set(passes[0][0])):
        keys, cs = passes.pop(0)
        w = Window.partitionBy(*keys, "__c")
        g = _level_mean(lambda x, w=w: F.sum(x).over(w), f, m)
        cells = cells.withColumn("__f", F.when(f.isNull() & (m > 0) & _all_not_null(keys) & own(cs), g).otherwise(f))
    if by:
        fills = _coarse_fills(cells, finest, cols, passes, own)
    else:
        # Only cells that received a fill matter for the join back.
        fills = cells.where("__f is not null").groupBy(*finest).agg(*[F.max(F.when(F.col("__c") == i, f)).alias(f"f__{c}") for i, c in enumerate(cols)])
    fills = fills.select(*[F.col(k).alias(f"k__{k}") for k in finest], *[f"f__{c}" for c in cols])
    fills, size = materialize_sized(fills, "impute_fills")
    if size <= BROADCAST_FILL_BYTES:
        fills = F.broadcast(fills)
    cond = [F.col(k).eqNullSafe(F.col(f"k__{k}")) for k in finest]
    joined = df.join(fills, on=reduce(lambda a, b: a & b, cond), how="left")
    out = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"f__{c}")) for c in cols})
    return out.select(*df.columns)


CELL = ["__c", *[f"__s{j}" for j in range(5)], "__n", "__m", "__w", "__f"]


def _coarse_fills(cells: DataFrame, finest: Level, cols: list[str], passes: list, own) -> DataFrame:
    """The rest of the chains over cells that lie together by some of the
    finest keys: a row per finest cell is written, with its columns' cells in an
    array; each level is an aggregation to its keys, joined back to those rows."""
    from airshed.session import materialize, materialize_sized
    packed = cells.groupBy(*finest).agg(F.collect_list(F.struct(*CELL)).alias("__cells"))
    if passes:
        packed = materialize(packed, "impute_cells")
    for keys, cs in passes:
        level = packed.select(*keys, F.inline("__cells")).where(_all_not_null(keys) & own(cs))
        means = level.groupBy(*keys, "__c").agg(_level_mean(F.sum, F.col("__f"), F.col("__m")).alias("__g")).where("__g is not null")
        means = means.groupBy(*[F.col(k).alias(f"l__{k}") for k in keys]).agg(F.map_from_entries(F.collect_list(F.struct("__c", "__g"))).alias("__g"))
        means, size = materialize_sized(means, "impute_level")
        if size <= BROADCAST_FILL_BYTES:
            means = F.broadcast(means)
        packed = packed.join(means, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"l__{k}") for k in keys]), "left")
        filled = F.transform("__cells", lambda x: x.withField("__f", F.when(x["__f"].isNull() & (x["__m"] > 0), F.col("__g")[x["__c"]]).otherwise(x["__f"])))
        packed = packed.withColumn("__cells", filled).select(*finest, "__cells")
    found = F.filter("__cells", lambda x: x["__f"].isNotNull())
    packed = packed.select(*finest, F.map_from_entries(F.transform(found, lambda x: F.struct(x["__c"], x["__f"]))).alias("__fills"))
    return packed.where(F.size("__fills") > 0).select(*finest, *[F.col("__fills")[i].alias(f"f__{c}") for i, c in enumerate(cols)])


def impute_chain_cells(df: DataFrame, cols: list[str], levels: list[Level]) -> DataFrame:
    return impute_many_cells(df, [(cols, levels)])


def impute_many(df: DataFrame, specs: list[Spec], method: str = "cells", by: Level | None = None) -> DataFrame:
    """Independent chains on disjoint columns (e.g. pollutants by city then
    country, and population by country) in one pass. ``by``: see
    ``impute_many_cells``."""
    seen: set[str] = set()
    for cs, _ in specs:
        if seen & set(cs):
            raise ValueError("chains of impute_many must have disjoint columns")
        seen |= set(cs)
    if method == "window":
        out = df
        for cs, levels in specs:
            out = impute_chain_window(out, cs, levels)
        return out
    if method == "cells":
        return impute_many_cells(df, specs, by)
    raise ValueError(f"unknown method {method!r}")


def impute_chain(df: DataFrame, cols: list[str], levels: list[Level],
                 method: str = "cells") -> DataFrame:
    """Fill nulls level by level (finest first)."""
    if method == "window":
        return impute_chain_window(df, cols, levels)
    if method == "cells":
        return impute_chain_cells(df, cols, levels)
    raise ValueError(f"unknown method {method!r}")


# I1
def impute_group_mean(df: DataFrame, cols: list[str], keys: Level, method: str = "cells") -> DataFrame:
    return impute_chain(df, cols, [keys], method)


# I7
def balance_fill_single_missing(df: DataFrame, total: str, parts: list[str]) -> DataFrame:
    """If exactly one of ``total`` and its parts is null, derive it
    (total = sum of parts; part = total - sum of the other parts). Every
    value comes from the row as it was before the step; negatives are kept."""
    allc = [total] + parts
    n_null = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in allc])
    one = n_null == 1
    fills = {total: reduce(lambda a, b: a + b, [F.col(p) for p in parts])}
    for p in parts:
        others = [F.coalesce(F.col(o), F.lit(0.0)) for o in parts if o != p]
        fills[p] = F.col(total) - reduce(lambda a, b: a + b, others)
    return df.withColumns({c: F.when(one & F.col(c).isNull(), fills[c]).otherwise(F.col(c))
                           for c in allc})


# I8
PER_CAPITA_SUFFIX = "_per_capita"


def derive_per_capita(df: DataFrame, per_capita_cols: list[str],
                      population: str = "population") -> DataFrame:
    """Fill a null ``X_per_capita`` with ``X / population`` when column X
    exists; division by zero gives null (D9), not inf."""
    exprs = {}
    for pc in per_capita_cols:
        base = pc.replace(PER_CAPITA_SUFFIX, "")
        if base in df.columns and pc in df.columns:
            exprs[pc] = F.coalesce(F.col(pc), F.try_divide(F.col(base), F.col(population)))
    return df.withColumns(exprs) if exprs else df


# I9
def derive_share_pct(df: DataFrame, parts: list[str], total: str, suffix: str = "_pct") -> DataFrame:
    """part / total * 100 with a zero total giving null."""
    return df.withColumns({f"{p}{suffix}": F.col(p) / F.nullif(F.col(total), F.lit(0.0)) * 100
                           for p in parts})
