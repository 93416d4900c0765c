"""Row generation and reshaping.

All generators are native (``explode_outer``, ``inline``, ``sequence``), so
they run inside the scan stage with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import NUMBER_PATTERN, number_shaped

# ---------------------------------------------------------------------------
# Fixed values that must match the reference for equal results.
# Source names of dim_source, in insertion order (ids 1..12).
SOURCE_NAMES = ["traffic", "industry", "biomass_burn", "dust", "sea_salt", "other",
                "coal", "gas", "oil", "cement", "flaring", "other_industry"]
# Pollutants of dim_pollutant with their units, in insertion order.
POLLUTANT_UNITS = [("pm10", "µg/m³"), ("pm25", "µg/m³"), ("no2", "µg/m³"),
                   ("co2", "MtCO2"), ("methane", "MtCH4"), ("nitrous_oxide", "MtN2O")]
# Apportionment shares as (source name, staging column), in unpivot order.
SHARE_SOURCES = [("traffic", "traffic"), ("industry", "industry"),
                 ("biomass_burn", "biomass_burn"), ("dust", "dust"),
                 ("sea_salt", "sea_salt"), ("other", "other_source")]
# Emission parts as (source name, value column, share column).
EMISSION_SOURCES = [("coal", "coal_co2", "coal_co2_pct"), ("gas", "gas_co2", "gas_co2_pct"),
                    ("oil", "oil_co2", "oil_co2_pct"), ("cement", "cement_co2", "cement_co2_pct"),
                    ("flaring", "flaring_co2", "flaring_co2_pct"),
                    ("other_industry", "other_industry_co2", "other_industry_co2_pct")]
# ---------------------------------------------------------------------------

_INT_LIMIT = 2.0 ** 31


# R1
def dash_years(c) -> "F.Column":
    """``'2010-2012'`` -> [2010, 2012]: each '-'-separated part that reads as
    a number, truncated to an int; nothing usable -> empty array."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.split(col.cast("string"), "-", -1)

    def to_year(p):
        # Python's float() also reads '2_010'; only such rare parts pay for
        # the full pattern, the rest pass a character-table check.
        has_us = F.locate("_", p) > 0
        ok = number_shaped(p, "_") & (~has_us | p.rlike(NUMBER_PATTERN))
        v = F.when(ok, F.trim(F.replace(p, F.lit("_"), F.lit(""))).try_cast("double"))
        return F.when(F.abs(v) < F.lit(_INT_LIMIT), v.cast("int"))

    years = F.filter(F.transform(parts, to_year), lambda y: y.isNotNull())
    return F.coalesce(years, F.array().cast(T.ArrayType(T.IntegerType())))


def explode_dash_years(df: DataFrame, col: str = "study_year") -> DataFrame:
    """One row per listed year (not the range in between); a value with no
    usable year keeps one row with a null year."""
    years = dash_years(col)
    exploded = F.explode_outer(F.when(F.size(years) > 0, years))
    return df.select(*[F.col(f"`{c}`") if c != col else exploded.alias(col) for c in df.columns])


# R2
def unpivot_source_shares(df: DataFrame, id_cols: list[str],
                          sources: list[tuple[str, str]] = SHARE_SOURCES,
                          name_col: str = "src", value_col: str = "val") -> DataFrame:
    """Wide -> long (source, value); null values dropped."""
    rows = F.array(*[F.struct(F.lit(n).alias(name_col), F.col(c).cast("double").alias(value_col))
                     for n, c in sources])
    return (df.select(*id_cols, F.inline(rows))
            .filter(F.col(value_col).isNotNull()))


# R3
def unpivot_emission_pairs(df: DataFrame, id_cols: list[str],
                           sources: list[tuple[str, str, str]] = EMISSION_SOURCES,
                           name_col: str = "src", value_col: str = "v_co2",
                           share_col: str = "v_pct") -> DataFrame:
    """Wide -> long with two values per source; dropped when the value is null."""
    rows = F.array(*[F.struct(F.lit(n).alias(name_col), F.col(v).cast("double").alias(value_col),
                              F.col(p).cast("double").alias(share_col))
                     for n, v, p in sources])
    return (df.select(*id_cols, F.inline(rows))
            .filter(F.col(value_col).isNotNull()))


# R4
def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed relation of literals (a handful of rows)."""
    return spark.createDataFrame(rows, schema)


def source_rows(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, [(n,) for n in SOURCE_NAMES], "source_name string")


def pollutant_rows(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, POLLUTANT_UNITS, "pollutant_name string, unit string")


# R5
def generate_horizon(df: DataFrame, start, end, name: str = "year") -> DataFrame:
    """One row per step from ``start`` to ``end``; nothing when start > end
    (``sequence`` alone would count down)."""
    s = F.col(start) if isinstance(start, str) else F.lit(start)
    e = F.col(end) if isinstance(end, str) else F.lit(end)
    steps = F.when(s <= e, F.sequence(s, e)).otherwise(F.array().cast(T.ArrayType(T.IntegerType())))
    return df.withColumn(name, F.explode(steps))
