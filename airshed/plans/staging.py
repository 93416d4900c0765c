"""Staging jobs: raw landed frame -> conformed staging frame.

Each job is ``DataFrame -> DataFrame``; the imputation steps write their small
fill tables while the plan is built. Writing, fingerprinting and upserting of
the result are done by ``airshed.plans.pipeline``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed import functions as fx
from airshed.operators import dedupe, impute, reshape, shape
from airshed.session import materialize
from airshed.sources.landing import scan_head_n

# ---------------------------------------------------------------------------
# Fixed values that must match the reference for equal results.
# d1 (station readings)
D1_DROP = ["reference", "web_link", "who_ms", "population_source"]
D1_RENAME = {
    "who_region": "region",
    "country_name": "country",
    "pm10_concentration": "concentration_pm10",
    "pm25_concentration": "concentration_pm25",
    "no2_concentration": "concentration_no2",
    "pm10_tempcov": "pm10_temp_cov",
    "pm25_tempcov": "pm25_temp_cov",
    "no2_tempcov": "no2_temp_cov",
    "type_of_stations": "station_type",
}
D1_POLLUTANTS = ["concentration_pm10", "concentration_pm25", "concentration_no2"]
D1_COVERAGE = ["pm10_temp_cov", "pm25_temp_cov", "no2_temp_cov"]
D1_TEXT = ["region", "iso3", "country", "city"]
D1_KEY = ["country", "city", "year"]
D1_COLUMNS = ["region", "iso3", "country", "city", "year",
              "concentration_pm10", "concentration_pm25", "concentration_no2",
              "pm10_temp_cov", "pm25_temp_cov", "no2_temp_cov",
              "station_type", "population", "latitude", "longitude"]

# d2, file 1 (studies sheet)
D2_STUDIES_RENAME = {
    "Site Location": "city",
    "Population estimate *": "population",
    "Country": "country",
    "ISO 3 code": "iso3",
    "Country Region": "region",
    "continent": "continent",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Site typology": "site_typology",
    "PM10 µgm-3 *": "concentration_pm10",
    "PM2.5 µgm-3 *": "concentration_pm25",
    "Methodology": "methodology",
    "Reference author": "reference_author",
    "Reference year": "study_year",
    "Study year": "year",
    "Season": "season",
    "SEA SALT%": "sea_salt",
    "DUST%": "dust",
    "TRAFFIC%": "traffic",
    "INDUSTRY%": "industry",
    "BIOM. BURN./RES.%": "biomass_burn",
    "OTHER (unspecified-human origin)%": "other_source",
}
D2_STUDIES_TEXT = ["city", "country", "iso3", "region", "continent", "site_typology",
                   "methodology", "reference_author", "season"]
D2_STUDIES_INT = ["population", "year", "study_year"]
D2_STUDIES_FLOAT = ["latitude", "longitude", "concentration_pm10", "concentration_pm25",
                    "sea_salt", "dust", "traffic", "industry", "biomass_burn", "other_source"]
D2_STUDIES_KEY = ["country", "city", "year"]
D2_STUDIES_MEAN = ["concentration_pm10", "concentration_pm25", "sea_salt", "dust", "traffic",
                   "industry", "biomass_burn", "other_source"]
D2_STUDIES_FIRST = ["population", "iso3", "region", "continent", "latitude", "longitude",
                    "site_typology"]
D2_STUDIES_CONCAT = ["methodology", "reference_author", "study_year", "season"]
D2_CONC = ["concentration_pm10", "concentration_pm25"]
D2_CONC_LEVELS = [["city", "year"], ["country", "year"], ["country"]]
D2_SHARES = ["sea_salt", "traffic", "industry", "dust", "biomass_burn", "other_source"]
D2_SHARE_LEVELS = [["city", "year"], ["city"], ["country", "year"], ["country"]]

# d2, file 2 (book)
D2_ALIASES = {
    "concentration_pm10": "concentration_pm10",
    "concentration_pm25": "concentration_pm25",
    "pm10": "concentration_pm10",
    "pm2.5": "concentration_pm25",
    "pm25": "concentration_pm25",
    "sea_salt": "sea_salt",
    "dust": "dust",
    "traffic": "traffic",
    "industry": "industry",
    "biomass_burn": "biomass_burn",
    "biomass": "biomass_burn",
    "other_source": "other_source",
    "other": "other_source",
    "methodology": "methodology",
    "reference_author": "reference_author",
    "site_typology": "site_typology",
    "population": "population",
    "iso3": "iso3",
    "region": "region",
    "continent": "continent",
    "latitude": "latitude",
    "longitude": "longitude",
    "season": "season",
    "country": "country",
    "city": "city",
    "year": "year",
    "study_year": "study_year",
}
D2_EXPECTED = {
    "country": "string",
    "city": "string",
    "year": "int",
    "study_year": "int",
    "concentration_pm10": "double",
    "concentration_pm25": "double",
    "sea_salt": "double",
    "dust": "double",
    "traffic": "double",
    "industry": "double",
    "biomass_burn": "double",
    "other_source": "double",
    "methodology": "string",
    "reference_author": "string",
    "site_typology": "string",
    "population": "double",
    "iso3": "string",
    "region": "string",
    "continent": "string",
    "latitude": "double",
    "longitude": "double",
    "season": "string",
}
D2_KEY = ["country", "city", "year", "methodology"]
D2_COLLAPSE_MEAN = ["concentration_pm10", "concentration_pm25", "sea_salt", "dust", "traffic",
                    "industry", "biomass_burn", "other_source", "latitude", "longitude",
                    "population", "study_year"]
D2_COLLAPSE_FIRST = ["iso3", "region", "continent", "reference_author", "site_typology", "season"]

# d3 (national emissions)
D3_MIN_YEAR = 1980
D3_EMISSIONS = ["co2", "cement_co2", "coal_co2", "consumption_co2", "flaring_co2", "gas_co2",
                "oil_co2", "other_industry_co2", "methane", "nitrous_oxide"]
D3_LEVELS = [["country", "year"], ["country"]]
D3_TOTAL = "co2"
D3_BALANCE_PARTS = ["cement_co2", "coal_co2", "flaring_co2", "gas_co2", "oil_co2",
                    "other_industry_co2"]
D3_PER_CAPITA = ["co2_per_capita", "cement_co2_per_capita", "coal_co2_per_capita",
                 "consumption_co2_per_capita", "flaring_co2_per_capita", "gas_co2_per_capita",
                 "oil_co2_per_capita", "other_co2_per_capita", "methane_per_capita",
                 "nitrous_oxide_per_capita"]
D3_CORE = ["co2", "cement_co2", "coal_co2", "consumption_co2", "flaring_co2", "gas_co2",
           "oil_co2", "other_industry_co2"]
D3_SHARE_SOURCES = ["cement_co2", "coal_co2", "flaring_co2", "gas_co2", "oil_co2",
                    "other_industry_co2"]
D3_COLUMNS = [
    "cement_co2_pct", "coal_co2_pct", "flaring_co2_pct", "gas_co2_pct", "oil_co2_pct",
    "other_industry_co2_pct",
    "cement_co2", "coal_co2", "consumption_co2", "flaring_co2", "gas_co2", "oil_co2",
    "other_industry_co2", "co2",
    "co2_per_capita", "cement_co2_per_capita", "coal_co2_per_capita",
    "consumption_co2_per_capita", "flaring_co2_per_capita", "gas_co2_per_capita",
    "oil_co2_per_capita", "other_co2_per_capita", "methane_per_capita",
    "nitrous_oxide_per_capita",
    "methane", "nitrous_oxide", "country", "year", "iso_code", "population",
]
D3_KEY = ["country", "year"]
# ---------------------------------------------------------------------------


# E1
def stage_air_quality(raw: DataFrame, method: str = "cells", keep_ord: bool = False) -> DataFrame:
    """P1, P2, I2, I6, F6, F8, P12, A5 in the reference's order."""
    df = shape.drop_columns_if_present(raw, D1_DROP)
    df = shape.rename_columns(df, D1_RENAME)
    # I2 and I6 touch disjoint columns, so they share one pass.
    specs = [(D1_POLLUTANTS + D1_COVERAGE, [["city"], ["country"]])]
    if "population" in df.columns:
        specs.append((["population"], [["country"]]))
    df = impute.impute_many(df, specs, method)
    df = df.withColumns({"latitude": fx.to_numeric_coerce("latitude"),
                         "longitude": fx.to_numeric_coerce("longitude")})
    df = df.withColumns({c: fx.to_string_nan(c) for c in D1_TEXT})
    df = shape.fill_null_int_zero(df, ["year"])
    df = dedupe.dedupe_keep_first(dedupe.sieve_first(df, D1_KEY), D1_KEY)
    return df.select(*D1_COLUMNS, *(["_ord"] if keep_ord else []))


# E2
def studies_conformed(raw: DataFrame, head_n: int | None = None) -> DataFrame:
    """S2 (only where ``head_n`` is given), P2, P6 of file 1 of d2."""
    df = scan_head_n(raw, head_n) if head_n is not None else raw
    df = shape.rename_columns(df, D2_STUDIES_RENAME)
    df = df.withColumns({c: F.col(c).cast("string") for c in D2_STUDIES_TEXT})
    df = df.withColumns({c: fx.to_int_or_zero(c, "bigint") for c in D2_STUDIES_INT})
    return df.withColumns({c: fx.to_numeric_coerce(c) for c in D2_STUDIES_FLOAT})


def studies_aggregated(raw: DataFrame, head_n: int | None = None) -> DataFrame:
    """... then A1 by (country, city, year)."""
    return dedupe.agg_mean_first_concat(studies_conformed(raw, head_n), D2_STUDIES_KEY, D2_STUDIES_MEAN,
                                        D2_STUDIES_FIRST, D2_STUDIES_CONCAT)


def stage_apportionment_studies(raw: DataFrame, head_n: int | None = None,
                                method: str = "cells") -> DataFrame:
    """S2, P2, P6, A1, I4, I5 (file 1 of d2)."""
    # Written once: the imputation reads it twice, for its cells and for the join back.
    df = materialize(studies_aggregated(raw, head_n), "studies")
    # A1 left a row per (country, city, year), so the cells are as many as the rows.
    return impute.impute_many(df, [(D2_CONC, D2_CONC_LEVELS), (D2_SHARES, D2_SHARE_LEVELS)], method, by=["city"])


# E3
def book_conformed(raw: DataFrame, year_col: str = "study_year") -> DataFrame:
    """R1, P3, P4, P5, P6 of file 2 of d2."""
    df = reshape.explode_dash_years(raw, year_col)
    df = shape.normalise_headers(df)
    df = shape.alias_columns(df, D2_ALIASES)
    df = shape.add_missing_columns(df, D2_EXPECTED)
    return shape.conform_types(df, D2_EXPECTED)


def stage_apportionment_book(raw: DataFrame, year_col: str = "study_year") -> DataFrame:
    """R1, P3, P4, P5, P6, A3, A5, P6 (file 2 of d2)."""
    df = book_conformed(raw, year_col)
    df = dedupe.collapse_duplicates(df, D2_KEY, D2_COLLAPSE_MEAN, D2_COLLAPSE_FIRST)
    # Unique keys after the collapse; A5 would be the identity here.
    df = df.withColumns({"study_year": fx.to_int_or_zero("study_year", "bigint", from_text=False),
                         "population": F.col("population").cast("double")})
    return df.select(*D2_KEY, *D2_COLLAPSE_MEAN, *D2_COLLAPSE_FIRST)


# E4
def stage_emissions(raw: DataFrame, min_year: int = D3_MIN_YEAR, method: str = "cells") -> DataFrame:
    """P8, I3, I7, I6, I8, P9, I9, P7."""
    df = shape.filter_after_year(raw, "year", min_year)
    # I6 (gdp, population by country) reads and writes columns that I3 and
    # I7 never touch, so it shares I3's pass; I7 then sees I3's fills. The
    # source has about a row per (country, year).
    extra = [c for c in ["gdp"] if c in df.columns]
    df = impute.impute_many(df, [(D3_EMISSIONS, D3_LEVELS), (extra + ["population"], [["country"]])], method, by=["country"])
    df = impute.balance_fill_single_missing(df, D3_TOTAL, D3_BALANCE_PARTS)
    df = impute.derive_per_capita(df, D3_PER_CAPITA)
    df = shape.filter_not_all_null(df, D3_CORE)
    df = impute.derive_share_pct(df, D3_SHARE_SOURCES, D3_TOTAL)
    return shape.project_final(df, D3_COLUMNS)
