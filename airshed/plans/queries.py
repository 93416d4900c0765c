"""Registered queries: one per operator key of SURVEY §2.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame built from the
driver tables (through ``airshed.sources.driver_landing``). ``ORACLES`` holds
the DuckDB SQL of the same result where SQL can express it.

Doubles are rounded to 6 decimals at the end of both sides so the compare
does not depend on the last bits of a float sum (summation order differs
between engines and between plan shapes).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ROUND = 6


def finish(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every double column for a last-bit-free compare."""
    fixes = {f.name: F.round(F.col(f"`{f.name}`"), digits) for f in df.schema.fields
             if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fixes) if fixes else df


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco
