"""Queries over the star that feed the analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.operators.changes import attach_scalar
from airshed.plans.star import Star

CITY_FEATURES = ["pm10", "pm25", "no2"]
COUNTRY_FEATURES = ["co2", "methane", "nitrous"]


def join_fact_location(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """J5 (AQE picks broadcast or shuffle from the runtime size)."""
    return fact.join(dim_location, "location_id")


def join_fact_time(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """J6."""
    return fact.join(dim_time.select("time_id", "year"), "time_id")


# A6
def avg_by_location(star: Star) -> DataFrame:
    """City pollution profile: the fact is averaged by its location first,
    and the places are joined to the few rows that remain."""
    means = star["fact_air_quality"].groupBy("location_id").agg(*[F.avg(c).alias(c) for c in CITY_FEATURES])
    return join_fact_location(means, star["dim_location"]).select("location_id", "country", "city", *CITY_FEATURES,
                                                                  "latitude", "longitude")


# A7
def sum_by_country(star: Star) -> DataFrame:
    """Country emission totals (national rows counted once per season, D1)."""
    gases = {"co2": "co2", "methane": "methane", "nitrous": "nitrous_oxide"}
    sums = star["fact_emissions"].groupBy("location_id").agg(*[F.sum(c).alias(k) for k, c in gases.items()])
    return join_fact_location(sums, star["dim_location"]).groupBy("country").agg(*[F.sum(k).alias(k) for k in gases])


# A9
def with_global_max(df: DataFrame, col: str = "year", name: str = "max_year") -> DataFrame:
    """Attach the global maximum of a column as a one-row broadcast side."""
    return attach_scalar(df, df.agg(F.max(col).alias(name)))


# S3
def scan_star_query(star: Star, sql: str, spark) -> DataFrame:
    """Run SQL over the star tables bound by name (``{fact_air_quality}``...)."""
    from airshed.plans.star import STAR_SCHEMAS
    return spark.sql(sql, **{k: star[k] for k in STAR_SCHEMAS if "{" + k + "}" in sql})
