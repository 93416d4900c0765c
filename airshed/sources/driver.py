"""Reading the driver's Parquet tables.

``run_sql`` runs a query template whose ``{table}`` placeholders are the
driver tables; Spark binds them as DataFrames (``spark.sql(text, **dfs)``),
so scans keep column pruning and filter pushdown.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def placeholders(template: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(template)))


# Named row filters applied to a driver table before a template runs:
# an "as of" snapshot of the orders (old and new loads of the same source).
SNAPSHOTS = {
    None: {},
    "until_1998": {"orders": "o_orderdate < DATE '1999-01-01'"},
    "from_1997": {"orders": "o_orderdate >= DATE '1997-01-01'"},
}


def run_sql(spark: SparkSession, sf_dir: str, template: str, snapshot: str | None = None) -> DataFrame:
    """Spark: bind each ``{name}`` to the driver table of that name."""
    filters = SNAPSHOTS[snapshot]
    dfs = {}
    for n in placeholders(template):
        df = load(spark, sf_dir, n)
        dfs[n] = df.filter(filters[n]) if n in filters else df
    return spark.sql(template.replace("ORDINAL(", "struct("), **dfs)


def as_duckdb(template: str, snapshot: str | None = None) -> str:
    """The same template for DuckDB, where the tables are plain views."""
    filters = SNAPSHOTS[snapshot]

    def sub(m):
        n = m.group(1)
        return f"(SELECT * FROM {n} WHERE {filters[n]})" if n in filters else n
    return _PLACEHOLDER.sub(sub, template).replace("ORDINAL(", "row(")
