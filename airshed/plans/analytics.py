"""Analytics jobs over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed import functions as fx
from airshed.operators import cluster as cl
from airshed.operators import forecast as fc
from airshed.operators import shape
from airshed.plans import marts
from airshed.plans.star import Star
from airshed.session import materialize

CITY = marts.CITY_FEATURES
COUNTRY = marts.COUNTRY_FEATURES


def city_features(star: Star, fill_all: bool = False) -> DataFrame:
    """A6 + P11: features null -> 0; lat/lon stay null unless ``fill_all``."""
    df = marts.avg_by_location(star)
    return shape.fill_null_zero(df, CITY + (["latitude", "longitude"] if fill_all else []))


def country_features(star: Star) -> DataFrame:
    return shape.fill_null_zero(marts.sum_by_country(star), COUNTRY)


# M8
def cluster_city_table(df: DataFrame) -> DataFrame:
    return df.select("country", "city", "latitude", "longitude", *CITY, "cluster", "cluster_name")


# M9
def cluster_country_table(df: DataFrame) -> DataFrame:
    """The choropleth data set: raw features, display text with units."""
    disp = {f"{f}_display": fx.round_with_unit(f, fx.UNIT_EMISSIONS) for f in COUNTRY}
    return df.select("country", *COUNTRY, "cluster", "cluster_name").withColumns(disp)


# E7 -- Ward
def cluster_cities(star: Star, n_clusters: int = 3, max_micro: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The places, and the profile of each named cluster."""
    df = cl.standardise(city_features(star), CITY, suffix="_z")
    df = df.withColumn("__x", cl.features_array([f"{c}_z" for c in CITY], "__x"))
    df = cl.ward_clusters(df, "__x", n_clusters, max_micro)
    df = materialize(cl.name_clusters(df, "cluster", "pm10", cl.WARD_NAMES), "city-clusters")
    return cluster_city_table(df), cl.cluster_profile(df, "cluster_name", CITY)


def cluster_countries(star: Star, n_clusters: int = 3, max_micro: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The countries, and the profile of each named cluster."""
    df = cl.log_standardise(country_features(star), COUNTRY, suffix="_log")
    df = df.withColumn("__x", cl.features_array([f"{c}_log" for c in COUNTRY], "__x"))
    df = cl.ward_clusters(df, "__x", n_clusters, max_micro)
    # The Ward script ranks countries on the mean of log1p(co2).
    df = materialize(cl.name_clusters(df, "cluster", "co2_log", cl.WARD_NAMES), "country-clusters")
    return cluster_country_table(df), cl.cluster_profile(df, "cluster_name", COUNTRY)


# E8 -- k-means with silhouette choice of k
def cluster_cities_kmeans(star: Star, max_k: int = cl.MAX_K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The places, the choice of k, and the profile of each named cluster."""
    df = cl.standardise(city_features(star), CITY, suffix="_z")
    df = materialize(df.withColumn("__x", cl.features_array([f"{c}_z" for c in CITY], "__x")), "city-features")
    table, k = cl.choose_k_silhouette(df, "__x", max_k)
    df = cl.name_clusters(cl.kmeans(df, "__x", k), "cluster", "pm10")
    return cluster_city_table(df), table, cl.cluster_profile(df, "cluster_name", CITY)


def cluster_countries_kmeans(star: Star, max_k: int = cl.MAX_K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The countries, the choice of k, and the profile of each named cluster."""
    df = cl.log_standardise(country_features(star), COUNTRY, suffix="_log")
    df = materialize(df.withColumn("__x", cl.features_array([f"{c}_log" for c in COUNTRY], "__x")), "country-features")
    table, k = cl.choose_k_silhouette(df, "__x", max_k)
    # The k-means script ranks countries on raw co2.
    df = cl.name_clusters(cl.kmeans(df, "__x", k), "cluster", "co2")
    return cluster_country_table(df), table, cl.cluster_profile(df, "cluster_name", COUNTRY)


# E9
def air_series(star: Star) -> DataFrame:
    """J6 + M12: long series (pollutant, location_id, year, value)."""
    j = marts.join_fact_time(star["fact_air_quality"], star["dim_time"])
    return fc.series_long(j)


def forecast_pollutants(series: DataFrame, end_year: int = fc.END_YEAR, out: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Back-test, mean errors per pollutant, and forecasts for all series
    (``air_series`` of a star).
    With ``out``, the forecasts are also written there as CSV, a folder per
    pollutant, and the mean errors beside them."""
    series = materialize(series, "series")
    backtest = materialize(fc.arima_backtest(series), "backtest")
    summary, forecasts = fc.mean_error_over_series(backtest), materialize(fc.arima_forecast(series, end_year), "forecasts")
    if out:
        forecasts.write.mode("overwrite").partitionBy("pollutant").option("header", True).csv(f"{out}/forecasts")
        summary.write.mode("overwrite").option("header", True).csv(f"{out}/mean_errors")
    return backtest, summary, forecasts
