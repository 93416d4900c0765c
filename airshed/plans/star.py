"""Star schema: dimensions, facts and their incremental load (SURVEY §2.13 E5,
§2.8 U10-U14, §2.1 S6).

Joins to the dimensions are plain equi-joins. ``dim_source`` and
``dim_pollutant`` are fixed literal tables (12 and 6 rows) and are broadcast
explicitly; ``dim_time`` and ``dim_location`` grow with the data, so the
broadcast decision is left to AQE's runtime size check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed import functions as fx
from airshed.operators import changes, reshape

# Table definitions (name -> schema, primary key).
# ---------------------------------------------------------------------------
# Fixed values that must match the reference for equal results.
STAR_SCHEMAS: dict[str, tuple[T.StructType, list[str]]] = {
    "dim_time": (T.StructType([T.StructField("time_id", T.IntegerType(), False),
                               T.StructField("year", T.LongType()),
                               T.StructField("season", T.StringType())]), ["time_id"]),
    "dim_location": (T.StructType([T.StructField("location_id", T.IntegerType(), False),
                                   T.StructField("country", T.StringType()),
                                   T.StructField("city", T.StringType()),
                                   T.StructField("region", T.StringType()),
                                   T.StructField("iso3", T.StringType()),
                                   T.StructField("latitude", T.DoubleType()),
                                   T.StructField("longitude", T.DoubleType())]), ["location_id"]),
    "dim_source": (T.StructType([T.StructField("source_id", T.IntegerType(), False),
                                 T.StructField("source_name", T.StringType())]), ["source_id"]),
    "dim_pollutant": (T.StructType([T.StructField("pollutant_id", T.IntegerType(), False),
                                    T.StructField("pollutant_name", T.StringType()),
                                    T.StructField("unit", T.StringType())]), ["pollutant_id"]),
    "fact_air_quality": (T.StructType([T.StructField("time_id", T.IntegerType()),
                                       T.StructField("location_id", T.IntegerType()),
                                       T.StructField("pm10", T.DoubleType()),
                                       T.StructField("pm25", T.DoubleType()),
                                       T.StructField("no2", T.DoubleType()),
                                       T.StructField("population", T.DoubleType()),
                                       T.StructField("station_type", T.StringType()),
                                       T.StructField("row_hash", T.StringType())]),
                         ["time_id", "location_id"]),
    "fact_source_apportionment": (T.StructType([T.StructField("time_id", T.IntegerType()),
                                                T.StructField("location_id", T.IntegerType()),
                                                T.StructField("source_id", T.IntegerType()),
                                                T.StructField("contribution_pct", T.DoubleType()),
                                                T.StructField("row_hash", T.StringType())]),
                                  ["time_id", "location_id", "source_id"]),
    "fact_emissions": (T.StructType([T.StructField("time_id", T.IntegerType()),
                                     T.StructField("location_id", T.IntegerType()),
                                     T.StructField("co2", T.DoubleType()),
                                     T.StructField("co2_per_capita", T.DoubleType()),
                                     T.StructField("methane", T.DoubleType()),
                                     T.StructField("nitrous_oxide", T.DoubleType()),
                                     T.StructField("population", T.DoubleType()),
                                     T.StructField("row_hash", T.StringType())]),
                       ["time_id", "location_id"]),
    "fact_emissions_by_source": (T.StructType([T.StructField("time_id", T.IntegerType()),
                                               T.StructField("location_id", T.IntegerType()),
                                               T.StructField("source_id", T.IntegerType()),
                                               T.StructField("co2", T.DoubleType()),
                                               T.StructField("co2_pct", T.DoubleType()),
                                               T.StructField("row_hash", T.StringType())]),
                                 ["time_id", "location_id", "source_id"]),
}
# Foreign keys: fact table -> [(column, dimension)].
FOREIGN_KEYS = {
    "fact_air_quality": [("time_id", "dim_time"), ("location_id", "dim_location")],
    "fact_source_apportionment": [("time_id", "dim_time"), ("location_id", "dim_location"),
                                  ("source_id", "dim_source")],
    "fact_emissions": [("time_id", "dim_time"), ("location_id", "dim_location")],
    "fact_emissions_by_source": [("time_id", "dim_time"), ("location_id", "dim_location"),
                                 ("source_id", "dim_source")],
}
DIMENSIONS = ["dim_time", "dim_location", "dim_source", "dim_pollutant"]
FACTS = ["fact_air_quality", "fact_source_apportionment", "fact_emissions", "fact_emissions_by_source"]

ANNUAL_SEASON = "year"
LOCATION_KEY = ["country", "city", "region", "iso3", "latitude", "longitude"]
TIME_KEY = ["year", "season"]
AIR_HASH = ["pm10", "pm25", "no2", "population", "station_type"]
EMISSIONS_HASH = ["co2", "co2_per_capita", "methane", "nitrous_oxide", "population"]
# ---------------------------------------------------------------------------


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    schema, _ = STAR_SCHEMAS[name]
    return spark.createDataFrame([], schema).limit(0)  # known to be empty, so joins with it are planned away


def create_star_schema(spark: SparkSession, existing: dict[str, DataFrame] | None = None
                       ) -> dict[str, DataFrame]:
    """Every star table, empty where it does not exist yet."""
    existing = existing or {}
    return {n: existing.get(n, empty_table(spark, n)) for n in STAR_SCHEMAS}


# ------------------------------------------------------------- dimensions
def time_candidates(d1: DataFrame, d2: DataFrame, d3: DataFrame) -> DataFrame:
    """U4: distinct (year, season) of the three stagings; d2's missing
    season is '' after conform, so COALESCE keeps it (D6)."""
    year = F.col("year").cast("bigint")
    return changes.union_distinct([
        d1.filter(F.col("year").isNotNull()).select(year.alias("year"), F.lit(ANNUAL_SEASON).alias("season")),
        d2.filter(F.col("year").isNotNull()).select(year.alias("year"),
                                                    F.coalesce("season", F.lit(ANNUAL_SEASON)).alias("season")),
        d3.filter(F.col("year").isNotNull()).select(year.alias("year"), F.lit(ANNUAL_SEASON).alias("season")),
    ])


def location_candidates(d1: DataFrame, d2: DataFrame, d3: DataFrame) -> DataFrame:
    """U4 + U5: distinct locations; national rows are padded with typed nulls."""
    def cities(df):
        return df.select("country", fx.split_part("city", "/", 1).alias("city"), "region", "iso3",
                         F.col("latitude").cast("double").alias("latitude"),
                         F.col("longitude").cast("double").alias("longitude"))
    national = d3.select("country", F.col("iso_code").alias("iso3"))
    return changes.union_distinct([cities(d1), cities(d2), national]).select(*LOCATION_KEY)


def fixed_dimension(spark: SparkSession, name: str) -> DataFrame:
    """dim_source / dim_pollutant with ids in listed order."""
    if name == "dim_source":
        rows = [(i + 1, n) for i, n in enumerate(reshape.SOURCE_NAMES)]
    else:
        rows = [(i + 1, n, u) for i, (n, u) in enumerate(reshape.POLLUTANT_UNITS)]
    return spark.createDataFrame(rows, STAR_SCHEMAS[name][0])


def load_dimensions(spark: SparkSession, d1: DataFrame, d2: DataFrame, d3: DataFrame,
                    current: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Insert-if-absent into each dimension (null-safe natural keys,
    so reruns do not append the same locations again, D3)."""
    out = dict(current)
    out["dim_time"] = changes.insert_if_absent(current["dim_time"], time_candidates(d1, d2, d3),
                                               TIME_KEY, "time_id")
    out["dim_location"] = changes.insert_if_absent(current["dim_location"],
                                                   location_candidates(d1, d2, d3),
                                                   LOCATION_KEY, "location_id")
    for name, key in (("dim_source", "source_name"), ("dim_pollutant", "pollutant_name")):
        fixed = fixed_dimension(spark, name)
        new = fixed.join(current[name].select(key), key, "left_anti")
        base = current[name].agg(F.coalesce(F.max(STAR_SCHEMAS[name][1][0]), F.lit(0)).alias("__b"))
        idc = STAR_SCHEMAS[name][1][0]
        new = changes.attach_scalar(new, base).withColumn(idc, (F.col(idc) + F.col("__b")).cast("int"))
        out[name] = current[name].unionByName(new.select(*current[name].columns))
    return out


# ------------------------------------------------------------------ facts
def _time(dim_time: DataFrame, time_grain: str) -> DataFrame:
    t = dim_time.select("time_id", F.col("year").alias("__year"), "season")
    if time_grain == "annual":
        t = t.filter(F.col("season") == ANNUAL_SEASON)
    elif time_grain != "year":
        raise ValueError(f"unknown time_grain {time_grain!r}")
    return t.drop("season")


def join_time_by_year(df: DataFrame, dim_time: DataFrame, time_grain: str = "year") -> DataFrame:
    """On year alone, so a year with several seasons fans out."""
    t = _time(dim_time, time_grain)
    return df.join(t, F.col("year").cast("bigint") == F.col("__year")).drop("__year")


def join_location_city(df: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Country and the first '/'-part of the city (key derived before
    the join so it is a plain equi-join)."""
    loc = dim_location.select("location_id", F.col("country").alias("__lc"), F.col("city").alias("__lcity"))
    keyed = df.withColumn("__city_key", fx.split_part("city", "/", 1))
    return (keyed.join(loc, (F.col("country") == F.col("__lc")) & (F.col("__city_key") == F.col("__lcity")))
            .drop("__lc", "__lcity", "__city_key"))


def join_location_national(df: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Only locations without a city, filtered before the join."""
    loc = (dim_location.filter(F.col("city").isNull())
           .select("location_id", F.col("country").alias("__lc")))
    return df.join(loc, F.col("country") == F.col("__lc")).drop("__lc")


def join_source_by_name(df: DataFrame, dim_source: DataFrame, name_col: str = "src") -> DataFrame:
    """AQE decides from the written dimension's size."""
    src = dim_source.select("source_id", F.col("source_name").alias("__sn"))
    return df.join(src, F.col(name_col) == F.col("__sn")).drop("__sn")


def fact_air_quality_batch(d1: DataFrame, dims: dict, time_grain: str = "year") -> DataFrame:
    """U11 batch: d1 -> J1, J2, U6."""
    df = join_location_city(join_time_by_year(d1, dims["dim_time"], time_grain), dims["dim_location"])
    df = df.select("time_id", "location_id", F.col("concentration_pm10").alias("pm10"),
                   F.col("concentration_pm25").alias("pm25"), F.col("concentration_no2").alias("no2"),
                   F.col("population").cast("double").alias("population"), "station_type")
    return df.withColumn("row_hash", fx.row_hash(df, AIR_HASH))


def fact_source_apportionment_batch(d2: DataFrame, dims: dict, time_grain: str = "year") -> DataFrame:
    """U12 batch: d2 -> J1, J2, R2, J4, U6."""
    df = join_location_city(join_time_by_year(d2, dims["dim_time"], time_grain), dims["dim_location"])
    long = reshape.unpivot_source_shares(df, ["time_id", "location_id"])
    long = join_source_by_name(long, dims["dim_source"])
    out = long.select("time_id", "location_id", "source_id", F.col("val").alias("contribution_pct"))
    return out.withColumn("row_hash", fx.row_hash(out, FACT_HASH["fact_source_apportionment"]))


def fact_emissions_batch(d3: DataFrame, dims: dict, time_grain: str = "year") -> DataFrame:
    """U13 batch: d3 -> J1, J3, U6."""
    df = join_location_national(join_time_by_year(d3, dims["dim_time"], time_grain), dims["dim_location"])
    df = df.select("time_id", "location_id", "co2", "co2_per_capita", "methane", "nitrous_oxide",
                   F.col("population").cast("double").alias("population"))
    return df.withColumn("row_hash", fx.row_hash(df, EMISSIONS_HASH))


def fact_emissions_by_source_batch(d3: DataFrame, dims: dict, time_grain: str = "year",
                                   coalesce_hash: bool = True) -> DataFrame:
    """U14 batch: d3 -> J1, J3, R3, J4, U6. ``coalesce_hash`` fixes D7 (a
    null share would null the hash and hide a changed co2)."""
    df = join_location_national(join_time_by_year(d3, dims["dim_time"], time_grain), dims["dim_location"])
    long = reshape.unpivot_emission_pairs(df, ["time_id", "location_id"])
    long = join_source_by_name(long, dims["dim_source"])
    out = long.select("time_id", "location_id", "source_id", F.col("v_co2").alias("co2"),
                      F.col("v_pct").alias("co2_pct"))
    return out.withColumn("row_hash", fx.row_hash(out, FACT_HASH["fact_emissions_by_source"], coalesce_nulls=coalesce_hash))


# The columns that each fact's row hash covers.
FACT_HASH = {
    "fact_air_quality": AIR_HASH,
    "fact_source_apportionment": ["contribution_pct"],
    "fact_emissions": EMISSIONS_HASH,
    "fact_emissions_by_source": ["co2", "co2_pct"],
}
FACT_BATCHES = {
    "fact_air_quality": ("d1", fact_air_quality_batch),
    "fact_source_apportionment": ("d2", fact_source_apportionment_batch),
    "fact_emissions": ("d3", fact_emissions_batch),
    "fact_emissions_by_source": ("d3", fact_emissions_by_source_batch),
}


def load_facts(stagings: dict[str, DataFrame], dims: dict[str, DataFrame],
               current: dict[str, DataFrame], time_grain: str = "year",
               on_duplicate: str = "error") -> dict[str, DataFrame]:
    """Each fact batch upserted into its table, rewriting only
    rows whose hash changed (U2)."""
    out = {}
    for name, (src, fn) in FACT_BATCHES.items():
        batch = fn(stagings[src], dims, time_grain)
        keys = STAR_SCHEMAS[name][1]
        out[name] = changes.upsert_changed_only(current[name], batch, keys,
                                                on_duplicate=on_duplicate)
    return out


@dataclass
class Star:
    tables: dict[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


# E5
def build_star(spark: SparkSession, d1: DataFrame, d2: DataFrame, d3: DataFrame,
               current: dict[str, DataFrame] | None = None, time_grain: str = "year",
               on_duplicate: str = "error") -> Star:
    """S6 + U10 + U11-U14 as lazy plans; ``current`` holds the tables as
    they are (empty on a first load)."""
    cur = create_star_schema(spark, current)
    dims = load_dimensions(spark, d1, d2, d3, cur)
    facts = load_facts({"d1": d1, "d2": d2, "d3": d3}, dims, cur, time_grain, on_duplicate)
    return Star({**dims, **facts})
