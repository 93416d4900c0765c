"""Schema shaping, projections and row filters.

All functions are ``DataFrame -> DataFrame`` and only add projections or
filters to the plan, so Catalyst pushes filters to the scan and prunes
columns the later steps never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed import functions as fx

# Declared types of the conform step: 'string', 'int' (bad -> 0) or
# 'double' (bad -> null).
TYPE_NAMES = {"string": T.StringType(), "int": T.LongType(), "double": T.DoubleType()}


# P1
def drop_columns_if_present(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


# P2
def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


# P3
def normalise_header(name: str) -> str:
    return str(name).lower().strip().replace(" ", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_header(c) for c in df.columns])


# P4
def alias_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Map accepted spellings to one name. When several spellings of one
    target are present they are coalesced in mapping order (D11) instead of
    producing duplicate column names."""
    targets: dict[str, list[str]] = {}
    for src, dst in mapping.items():
        if src in df.columns:
            srcs = targets.setdefault(dst, [])
            if src not in srcs:
                srcs.append(src)
    placed: set[str] = set()
    out = []
    for c in df.columns:
        owner = next((d for d, srcs in targets.items() if c in srcs or c == d), None)
        if owner is None:
            out.append(F.col(f"`{c}`"))
            continue
        if owner in placed:
            continue
        srcs = targets[owner]
        e = (F.coalesce(*[F.col(f"`{x}`") for x in srcs]) if len(srcs) > 1
             else F.col(f"`{srcs[0]}`"))
        out.append(e.alias(owner))
        placed.add(owner)
    return df.select(*out)


# P5
def add_missing_columns(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    missing = {c: F.lit(None).cast(TYPE_NAMES.get(t, T.StringType()))
               for c, t in spec.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


# P6
def conform_expr(c: str, kind: str, source_type: T.DataType | None = None):
    col = F.col(f"`{c}`")
    if kind == "string":
        return fx.text_null_to_empty(col)
    if kind == "int":
        from_text = isinstance(source_type, T.StringType) or source_type is None
        return fx.to_int_or_zero(col, "bigint", from_text=from_text)
    if kind == "double":
        if isinstance(source_type, T.StringType):
            return fx.to_numeric_coerce(col)
        return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    raise ValueError(f"unknown declared type {kind!r}")


def conform_types(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Cast by declared type: string (missing -> ''), int (bad -> 0,
    truncated), double (bad -> null). Never a plain ``cast``: ANSI raises."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: conform_expr(c, k, types.get(c)) for c, k in spec.items()
                           if c in df.columns})


def conform(df: DataFrame, rename: dict[str, str] | None = None,
            aliases: dict[str, str] | None = None, spec: dict[str, str] | None = None,
            normalise: bool = False) -> DataFrame:
    """rename -> normalise headers -> aliases -> add missing -> cast."""
    out = rename_columns(df, rename) if rename else df
    out = normalise_headers(out) if normalise else out
    out = alias_columns(out, aliases) if aliases else out
    if spec:
        out = conform_types(add_missing_columns(out, spec), spec)
    return out


# P7
def project_final(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


# P8
def filter_after_year(df: DataFrame, col: str = "year", min_year: int = 1980) -> DataFrame:
    """Strictly after ``min_year``; a null year is dropped (as in pandas)."""
    return df.filter(F.col(col) > F.lit(min_year))


# P9
def filter_not_all_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


# P10
def filter_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=cols)


# P11
def fill_null_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null -> 0 on the given numeric columns (all numeric ones if None)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.na.fill(0, subset=cols)


# P12
def fill_null_int_zero(df: DataFrame, cols: list[str], target: str = "int") -> DataFrame:
    """Missing -> 0, then truncate to an int (``fillna(0).astype(int)``)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).cast(target)
                           for c in cols})


# P13
def delete_by_match(df: DataFrame, col: str, value: str, normalise: bool = True) -> DataFrame:
    """Keep rows whose key does not match; null keys never match."""
    left = fx.trim_lower(col) if normalise else F.col(col)
    right = fx.trim_lower(F.lit(value)) if normalise else F.lit(value)
    return df.filter(~F.coalesce(left == right, F.lit(False)))


# S7
def add_missing_audit_column(df: DataFrame, col: str = "updated_at") -> DataFrame:
    if col in df.columns:
        return df
    return df.withColumn(col, F.current_timestamp())


# P14
def stamp_updated_at(df: DataFrame, col: str = "updated_at") -> DataFrame:
    return df.withColumn(col, F.current_timestamp())
