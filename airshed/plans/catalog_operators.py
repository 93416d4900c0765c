"""Registered per-operator queries: sources and sinks (S1-S7), shaping and
filters (P1-P14), imputation (I1-I9), reshaping (R1, R4), aggregation and
dedupe (A1-A5), scalar functions (F1-F15), changes (U1-U3, U6-U9) and the
whole pipeline (E6). Inputs are the landed frames derived from the driver
tables; the oracles reuse the SQL stagings of ``oracle_sql``."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed import functions as fx
from airshed.operators import changes, dedupe, impute, reshape, shape
from airshed.plans import oracle_sql as osql
from airshed.plans import pipeline as pl
from airshed.plans import staging as st
from airshed.plans import star as sk
from airshed.plans.catalog_star import dim_star, landed, stagings, star
from airshed.plans.queries import finish, register
from airshed.session import materialize, scratch_path
from airshed.sources import driver_landing as dl
from airshed.sources import landing
from airshed.sources.tables import TableStore

W = osql.with_ctes
R = osql.rounded
D1C, _ = osql.stage_d1_ctes()
D2BC, _ = osql.stage_d2_book_ctes()
D2SC, _ = osql.stage_d2_studies_ctes()
D3C, _ = osql.stage_d3_ctes()
D1_RAW_DOUBLES = ["year", "pm10_concentration", "pm25_concentration", "no2_concentration", "pm10_tempcov",
                  "pm25_tempcov", "no2_tempcov", "population"]
D1_REN_DOUBLES = ["year"] + st.D1_POLLUTANTS + st.D1_COVERAGE + ["population"]
D3_RAW_DOUBLES = [c for c in st.D3_COLUMNS if c not in ("country", "year", "iso_code") and not c.endswith("_pct")]


def raw_d1(spark, sf):
    return landed(spark, sf, "d1")


def renamed_d1(spark, sf):
    return shape.rename_columns(shape.drop_columns_if_present(raw_d1(spark, sf), st.D1_DROP), st.D1_RENAME)


def raw_d3(spark, sf):
    return landed(spark, sf, "d3")


def book(spark, sf):
    return landed(spark, sf, "d2")


def studies(spark, sf):
    return landed(spark, sf, "d2s")


# ------------------------------------------------------------- S1-S7
@register("scan_landing", R(W(D1C, "SELECT * EXCLUDE (_ord) FROM d1_raw"), D1_RAW_DOUBLES))
def q_scan_landing(spark, sf):
    df = raw_d1(spark, sf).drop("_ord")
    path = scratch_path(spark, "landing_d1")
    df.write.option("header", True).csv(path)
    back = landing.scan_landing(spark, path, df.schema, fmt="csv")
    return finish(back.drop("_ord"))


@register("scan_head_n", W(D2SC, "SELECT _ord, country, city FROM d2s_raw ORDER BY _ord LIMIT 527"))
def q_scan_head_n(spark, sf):
    raw = studies(spark, sf)
    return landing.scan_head_n(raw, 527).select("_ord", F.col("Country").alias("country"),
                                                F.col("Site Location").alias("city"))


@register("sink_csv_snapshot", osql.e4_sql())
def q_sink_csv_snapshot(spark, sf):
    df = stagings(spark, sf)["d3"]
    path = scratch_path(spark, "staging_csv_d3")
    landing.sink_csv_snapshot(df, path)
    return finish(landing.read_csv_snapshot(spark, path, df.schema))


@register("sink_stage_replace", osql.e1_sql())
def q_sink_stage_replace(spark, sf):
    stagings(spark, sf)["d1"].createOrReplaceTempView("temp_staging_d1")
    casts = {"year": "int", "station_type": "string", "region": "string", "iso3": "string",
             "country": "string", "city": "string"}
    cols = ", ".join(f"CAST({c} AS {casts.get(c, 'double')}) AS {c}" for c in st.D1_COLUMNS)
    staged = spark.sql(f"SELECT {cols} FROM temp_staging_d1")
    spark.catalog.dropTempView("temp_staging_d1")  # the plan holds what the view stood for
    return finish(staged)


@register("add_missing_audit_column", W(D3C, "SELECT country, year, TRUE AS has_updated_at FROM stg_d3"))
def q_add_missing_audit_column(spark, sf):
    df = shape.add_missing_audit_column(stagings(spark, sf)["d3"])
    df = shape.add_missing_audit_column(df)  # a second call keeps the column as is
    return df.select("country", "year", F.col("updated_at").isNotNull().alias("has_updated_at"))


@register("stamp_updated_at", W(D1C, "SELECT country, city, year, TRUE AS has_updated_at FROM stg_d1"))
def q_stamp_updated_at(spark, sf):
    df = shape.stamp_updated_at(stagings(spark, sf)["d1"])
    return df.select("country", "city", "year", F.col("updated_at").isNotNull().alias("has_updated_at"))


# ------------------------------------------------------------- P1-P14
@register("drop_columns_if_present",
          R(W(D1C, "SELECT * EXCLUDE (_ord, reference, web_link) FROM d1_raw"), D1_RAW_DOUBLES))
def q_drop_columns_if_present(spark, sf):
    return finish(shape.drop_columns_if_present(raw_d1(spark, sf), st.D1_DROP).drop("_ord"))


@register("rename_columns", R(W(D1C, "SELECT * EXCLUDE (_ord) FROM d1_ren"), D1_REN_DOUBLES))
def q_rename_columns(spark, sf):
    return finish(renamed_d1(spark, sf).drop("_ord"))


BOOK_NORMALISED = """
SELECT study_year, country, city, yr AS year, methodology, reference_author, site_typology, iso3, region,
       season, pm10, pm25 AS "pm2.5", sea_salt, dust, traffic, industry, biomass, other, population,
       latitude, longitude, notes FROM d2b_raw"""


@register("normalise_headers", W(D2BC, BOOK_NORMALISED))
def q_normalise_headers(spark, sf):
    return shape.normalise_headers(book(spark, sf).drop("_ord"))


BOOK_ALIASED = """
SELECT study_year, country, city, yr AS year, methodology, reference_author, site_typology, iso3, region,
       season, pm10 AS concentration_pm10, pm25 AS concentration_pm25, sea_salt, dust, traffic, industry,
       biomass AS biomass_burn, other AS other_source, population, latitude, longitude, notes FROM d2b_raw"""


@register("alias_columns", W(D2BC, BOOK_ALIASED))
def q_alias_columns(spark, sf):
    return shape.alias_columns(shape.normalise_headers(book(spark, sf).drop("_ord")), st.D2_ALIASES)


@register("add_missing_columns", W(D2BC, f"SELECT *, NULL::VARCHAR AS continent FROM ({BOOK_ALIASED})"))
def q_add_missing_columns(spark, sf):
    df = shape.alias_columns(shape.normalise_headers(book(spark, sf).drop("_ord")), st.D2_ALIASES)
    return shape.add_missing_columns(df, st.D2_EXPECTED)


CONFORMED_DOUBLES = [c for c, t in st.D2_EXPECTED.items() if t == "double"]


@register("conform_types", R(W(D2BC, "SELECT * EXCLUDE (_ord) FROM d2b_c"), CONFORMED_DOUBLES))
def q_conform_types(spark, sf):
    return finish(st.book_conformed(book(spark, sf)).select(*st.D2_EXPECTED))


@register("project_final", R(W(D3C, "SELECT country, year, co2, population FROM d3_raw"), ["co2", "population"]))
def q_project_final(spark, sf):
    return finish(shape.project_final(raw_d3(spark, sf), ["country", "year", "co2", "population"]))


@register("filter_after_year", W(D3C, "SELECT country, year FROM d3_raw WHERE year > 1980"))
def q_filter_after_year(spark, sf):
    return shape.filter_after_year(raw_d3(spark, sf), "year", st.D3_MIN_YEAR).select("country", "year")


@register("filter_not_all_null", W(D3C, f"SELECT country, year FROM d3_raw WHERE coalesce({', '.join(st.D3_CORE)}) "
                                        "IS NOT NULL"))
def q_filter_not_all_null(spark, sf):
    return shape.filter_not_all_null(raw_d3(spark, sf), st.D3_CORE).select("country", "year")


@register("filter_not_null", R(W(D1C, "SELECT country, city, year, concentration_pm10 FROM d1_ren "
                                      "WHERE year IS NOT NULL"), ["year", "concentration_pm10"]))
def q_filter_not_null(spark, sf):
    return finish(shape.filter_not_null(renamed_d1(spark, sf), ["year"])
                  .select("country", "city", "year", "concentration_pm10"))


@register("fill_null_int_zero", W(D1C, "SELECT country, city, CAST(trunc(coalesce(year, 0)) AS INTEGER) AS year "
                                       "FROM d1_ren"))
def q_fill_null_int_zero(spark, sf):
    return shape.fill_null_int_zero(renamed_d1(spark, sf), ["year"]).select("country", "city", "year")


@register("delete_by_match", R(W(D1C, f"SELECT {', '.join(st.D1_COLUMNS)} FROM stg_d1 WHERE NOT "
                                      "coalesce(lower(trim(city)) = lower(trim(' SUPPLIER#000000001 ')), false)"),
                               osql.D1_DOUBLES))
def q_delete_by_match(spark, sf):
    return finish(shape.delete_by_match(stagings(spark, sf)["d1"], "city", " SUPPLIER#000000001 "))


# ------------------------------------------------------------- I1-I9
def _imp_sql(ctes, src, cols, levels, select, doubles):
    c, last = osql.impute_chain(src, cols, levels, "q_imp")
    return R(W(ctes + c, f"SELECT {select} FROM {last}"), doubles)


@register("impute_group_mean", _imp_sql(D1C, "d1_ren", ["concentration_pm10"], [["city"]],
                                        "country, city, year, concentration_pm10", ["year", "concentration_pm10"]))
def q_impute_group_mean(spark, sf):
    df = impute.impute_group_mean(renamed_d1(spark, sf), ["concentration_pm10"], ["city"])
    return finish(df.select("country", "city", "year", "concentration_pm10"))


I2_COLS = st.D1_POLLUTANTS + st.D1_COVERAGE


@register("impute_city_then_country", _imp_sql(D1C, "d1_ren", I2_COLS, [["city"], ["country"]],
                                               "country, city, year, " + ", ".join(I2_COLS), ["year"] + I2_COLS))
def q_impute_city_then_country(spark, sf):
    df = impute.impute_chain(renamed_d1(spark, sf), I2_COLS, [["city"], ["country"]])
    return finish(df.select("country", "city", "year", *I2_COLS))


@register("impute_year_then_country", _imp_sql(D3C, "d3_f", st.D3_EMISSIONS, st.D3_LEVELS,
                                               "country, year, " + ", ".join(st.D3_EMISSIONS), st.D3_EMISSIONS))
def q_impute_year_then_country(spark, sf):
    df = shape.filter_after_year(raw_d3(spark, sf), "year", st.D3_MIN_YEAR)
    df = impute.impute_chain(df, st.D3_EMISSIONS, st.D3_LEVELS)
    return finish(df.select("country", "year", *st.D3_EMISSIONS))


@register("impute_three_level", _imp_sql(D2SC, "d2s_a", st.D2_CONC, st.D2_CONC_LEVELS,
                                         "country, city, year, " + ", ".join(st.D2_CONC), st.D2_CONC))
def q_impute_three_level(spark, sf):
    df = st.studies_aggregated(studies(spark, sf), head_n=None)
    df = impute.impute_chain(df, st.D2_CONC, st.D2_CONC_LEVELS)
    return finish(df.select("country", "city", "year", *st.D2_CONC))


@register("impute_four_level", _imp_sql(D2SC, "d2s_a", st.D2_SHARES, st.D2_SHARE_LEVELS,
                                        "country, city, year, " + ", ".join(st.D2_SHARES), st.D2_SHARES))
def q_impute_four_level(spark, sf):
    df = materialize(st.studies_aggregated(studies(spark, sf)), "studies")
    df = impute.impute_chain(df, st.D2_SHARES, st.D2_SHARE_LEVELS)
    return finish(df.select("country", "city", "year", *st.D2_SHARES))


@register("impute_attribute_by_country", _imp_sql(D1C, "d1_ren", ["population"], [["country"]],
                                                  "country, city, year, population", ["year", "population"]))
def q_impute_attribute_by_country(spark, sf):
    df = impute.impute_group_mean(renamed_d1(spark, sf), ["population"], ["country"])
    return finish(df.select("country", "city", "year", "population"))


BAL = [st.D3_TOTAL] + st.D3_BALANCE_PARTS


@register("balance_fill_single_missing", R(W(D3C + [("q_bal", osql.balance_sql("d3_raw"))],
                                             f"SELECT country, year, {', '.join(BAL)} FROM q_bal"), BAL))
def q_balance_fill_single_missing(spark, sf):
    df = impute.balance_fill_single_missing(raw_d3(spark, sf), st.D3_TOTAL, st.D3_BALANCE_PARTS)
    return finish(df.select("country", "year", *BAL))


PC = [pc for pc in st.D3_PER_CAPITA]


@register("derive_per_capita", R(W(D3C, "SELECT country, year, " + ", ".join(
    (f"coalesce({pc}, {pc.replace('_per_capita', '')} / nullif(population, 0)) AS {pc}"
     if pc.replace("_per_capita", "") in st.D3_EMISSIONS else pc) for pc in PC) + " FROM d3_raw"), PC))
def q_derive_per_capita(spark, sf):
    return finish(impute.derive_per_capita(raw_d3(spark, sf), PC).select("country", "year", *PC))


PCT = [f"{s}_pct" for s in st.D3_SHARE_SOURCES]


@register("derive_share_pct", R(W(D3C, "SELECT country, year, " + ", ".join(
    f"{s} / nullif(co2, 0) * 100 AS {s}_pct" for s in st.D3_SHARE_SOURCES) + " FROM d3_raw"), PCT))
def q_derive_share_pct(spark, sf):
    return finish(impute.derive_share_pct(raw_d3(spark, sf), st.D3_SHARE_SOURCES, st.D3_TOTAL)
                  .select("country", "year", *PCT))


# ------------------------------------------------------------- R1, R4
# Years compared as text: an int column with nulls has no common pandas type.
@register("explode_dash_years", W(D2BC, "SELECT _ord, CAST(study_year AS VARCHAR) AS study_year FROM d2b_x"))
def q_explode_dash_years(spark, sf):
    return (reshape.explode_dash_years(book(spark, sf), "study_year")
            .select("_ord", F.col("study_year").cast("string").alias("study_year")))


@register("inline_rows", osql.star_sql("""
SELECT ds.source_id, ds.source_name, coalesce(c.n, 0) AS n_fact_rows
FROM dim_source ds LEFT JOIN (
  SELECT source_id, count(*) AS n FROM (SELECT source_id FROM fact_source_apportionment
                                        UNION ALL SELECT source_id FROM fact_emissions_by_source)
  GROUP BY source_id) c USING (source_id)"""))
def q_inline_rows(spark, sf):
    s = star(spark, sf)
    fixed = reshape.source_rows(spark)
    ids = sk.fixed_dimension(spark, "dim_source")
    used = (s["fact_source_apportionment"].select("source_id")
            .unionByName(s["fact_emissions_by_source"].select("source_id"))
            .groupBy("source_id").agg(F.count(F.lit(1)).alias("n")))
    return (fixed.join(ids, "source_name").join(used, "source_id", "left")
            .select("source_id", "source_name", F.coalesce("n", F.lit(0)).alias("n_fact_rows")))


# ------------------------------------------------------------- A1-A5
A1_DOUBLES = st.D2_STUDIES_MEAN + ["latitude", "longitude"]


@register("agg_mean_first_concat", R(W(D2SC, "SELECT * FROM d2s_a"), A1_DOUBLES))
def q_agg_mean_first_concat(spark, sf):
    return finish(st.studies_aggregated(studies(spark, sf), head_n=None))


@register("agg_distinct_concat", W(D2SC, "SELECT country, city, year, " + ", ".join(
    f"coalesce({c}, '') AS {c}" for c in st.D2_STUDIES_CONCAT) + " FROM d2s_cat_w"))
def q_agg_distinct_concat(spark, sf):
    df = st.studies_conformed(studies(spark, sf), head_n=None).dropna(subset=st.D2_STUDIES_KEY)
    return dedupe.agg_distinct_concat(df, st.D2_STUDIES_KEY, st.D2_STUDIES_CONCAT)


COLLAPSE_SQL = ("SELECT " + ", ".join(st.D2_KEY) + ", " + ", ".join(f"avg({c}) AS {c}" for c in st.D2_COLLAPSE_MEAN)
                + ", " + ", ".join(f"coalesce(arg_min({c}, _ord), '') AS {c}" for c in st.D2_COLLAPSE_FIRST)
                + " FROM d2b_c GROUP BY " + ", ".join(st.D2_KEY))


@register("collapse_duplicates", R(W(D2BC, COLLAPSE_SQL), st.D2_COLLAPSE_MEAN))
def q_collapse_duplicates(spark, sf):
    df = dedupe.collapse_duplicates(st.book_conformed(book(spark, sf)), st.D2_KEY, st.D2_COLLAPSE_MEAN,
                                    st.D2_COLLAPSE_FIRST)
    return finish(df.drop("_ord"))


@register("count_duplicates", W(D2BC, """
SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS n_in_duplicate_groups,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_surplus, count(*) AS n_keys,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows
FROM (SELECT count(*) AS n FROM d2b_c GROUP BY country, city, year, methodology)"""))
def q_count_duplicates(spark, sf):
    return dedupe.count_duplicates(st.book_conformed(book(spark, sf)), st.D2_KEY)


@register("dedupe_keep_first", R(W(D1C, f"""
SELECT country, city, year, concentration_pm10, station_type FROM (
  SELECT *, row_number() OVER (PARTITION BY country, city, year ORDER BY _ord) AS rn FROM d1_ren)
WHERE rn = 1"""), ["year", "concentration_pm10"]))
def q_dedupe_keep_first(spark, sf):
    df = renamed_d1(spark, sf).select("_ord", "country", "city", "year", "concentration_pm10", "station_type")
    return finish(dedupe.dedupe_keep_first(df, st.D1_KEY).drop("_ord"))


# ------------------------------------------------------------- F1-F15
@register("split_part", W(D1C, "SELECT city, split_part(city, '/', 1) AS city_key FROM stg_d1"))
def q_split_part(spark, sf):
    return stagings(spark, sf)["d1"].select("city", fx.split_part("city", "/", 1).alias("city_key"))


@register("trim_lower", W(D1C, "SELECT city, lower(trim(city)) AS city_norm FROM stg_d1"))
def q_trim_lower(spark, sf):
    return stagings(spark, sf)["d1"].select("city", fx.trim_lower("city").alias("city_norm"))


@register("coalesce", R(W(D1C, "SELECT country_name AS country, coalesce(pm10_concentration, pm25_concentration, 0) AS value "
                               "FROM d1_raw"), ["value"]))
def q_coalesce(spark, sf):
    return finish(raw_d1(spark, sf).select("country_name", F.coalesce("pm10_concentration", "pm25_concentration",
                                                                      F.lit(0.0)).alias("value"))
                  .withColumnRenamed("country_name", "country"))


@register("md5", W(D1C, "SELECT city, md5(city) AS city_md5 FROM stg_d1"))
def q_md5(spark, sf):
    return stagings(spark, sf)["d1"].select("city", F.md5("city").alias("city_md5"))


@register("concat", W(D1C, "SELECT city || '|' || iso3 AS joined, concat_ws('|', city, iso3) AS joined_ws "
                           "FROM d1_raw"))
def q_concat(spark, sf):
    df = raw_d1(spark, sf)
    return df.select(F.concat("city", F.lit("|"), "iso3").alias("joined"),
                     F.concat_ws("|", "city", "iso3").alias("joined_ws"))


@register("to_numeric_coerce", R(W(D2BC, "SELECT _ord, pm10, TRY_CAST(pm10 AS DOUBLE) AS pm10_value FROM d2b_raw"),
                                 ["pm10_value"]))
def q_to_numeric_coerce(spark, sf):
    df = book(spark, sf)
    return finish(df.select("_ord", F.col("PM10").alias("pm10"), fx.to_numeric_coerce("PM10").alias("pm10_value")))


@register("text_null_to_empty", W(D2BC, f"SELECT _ord, {osql.text_or_empty('season')} AS season FROM d2b_raw"))
def q_text_null_to_empty(spark, sf):
    return book(spark, sf).select("_ord", fx.text_null_to_empty("Season").alias("season"))


@register("to_string_nan", W(D1C, "SELECT country_name AS country, coalesce(city, 'nan') AS city FROM d1_raw"))
def q_to_string_nan(spark, sf):
    return raw_d1(spark, sf).select(F.col("country_name").alias("country"), fx.to_string_nan("city").alias("city"))


@register("type_casts", W(D2BC, "SELECT country, city, CAST(year AS INTEGER) AS year, "
                                "CAST(study_year AS INTEGER) AS study_year, CAST(population AS VARCHAR) AS population_text "
                                "FROM stg_d2"))
def q_type_casts(spark, sf):
    d2 = stagings(spark, sf)["d2"]
    return d2.select("country", "city", F.col("year").cast("int").alias("year"),
                     F.col("study_year").cast("int").alias("study_year"),
                     F.col("population").cast("string").alias("population_text"))


@register("nullif_zero", R(W(D3C, "SELECT country, year, nullif(population, 0) AS population FROM d3_raw"),
                           ["population"]))
def q_nullif_zero(spark, sf):
    return finish(raw_d3(spark, sf).select("country", "year", fx.nullif_zero("population").alias("population")))


LABEL_NAMES = {i: f"Group {chr(65 + i)}" for i in range(10)}


@register("map_values", "SELECT vec_id, label, CASE label " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in LABEL_NAMES.items()) + " END AS label_name FROM embeddings")
def q_map_values(spark, sf):
    from airshed.sources.driver import load
    e = load(spark, sf, "embeddings")
    return e.select("vec_id", "label", fx.map_values("label", LABEL_NAMES).alias("label_name"))


def _snap_d3_sql(body: str, doubles=()):
    a, _ = osql.stage_d3_ctes("a_", "until_1998")
    b, _ = osql.stage_d3_ctes("b_", "from_1997")
    return R(W(a + b, body), list(doubles))


@register("is_distinct_from", _snap_d3_sql("""
SELECT country, year, round(a.co2, 6) IS DISTINCT FROM round(b.co2, 6) AS co2_changed
FROM a_stg_d3 a FULL JOIN b_stg_d3 b USING (country, year)"""))
def q_is_distinct_from(spark, sf):
    a = stagings(spark, sf, "until_1998")["d3"].select("country", "year", F.col("co2").alias("a"))
    b = stagings(spark, sf, "from_1997")["d3"].select("country", "year", F.col("co2").alias("b"))
    # Full outer: a key in one snapshot only has changed, unless its value there is null.
    return a.join(b, ["country", "year"], "full_outer").select(
        "country", "year", fx.is_distinct_from(F.round("a", 6), F.round("b", 6)).alias("co2_changed"))


# ------------------------------------------------------------- U1-U3, U6-U9
D1_HASH = ["concentration_pm10", "concentration_pm25", "concentration_no2", "population", "station_type"]


@register("row_hash", W(D1C, "SELECT country, city, year, " + osql.row_hash_sql(
    [(c, c != "station_type") for c in D1_HASH]) + " AS row_hash FROM stg_d1"))
def q_row_hash(spark, sf):
    d1 = stagings(spark, sf)["d1"]
    return d1.select("country", "city", "year", fx.row_hash(d1, D1_HASH).alias("row_hash"))


def _encoded_sql(cols: list[tuple[str, bool]]) -> str:
    sized = lambda t: f"CAST(length({t}) AS VARCHAR) || ':' || {t}"
    return " || ".join(f"coalesce({osql.hash_text_sql(c, True) if d else sized(osql.hash_text_sql(c, False))} || ';', '-;')" for c, d in sorted(cols, key=lambda x: x[1]))


def fingerprint_sql(src: str, cols: list[tuple[str, bool]], keys: list[str]) -> str:
    key = _encoded_sql([c for c in cols if c[0] in keys])
    return (f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, md5(coalesce(string_agg(bucket || ':' || n || ':' || digest, ',' ORDER BY bucket), '')) AS digest FROM ("
            f"SELECT ('0x' || substr(md5({key}), 1, 7))::BIGINT % {changes.BUCKETS} AS bucket, count(*) AS n, "
            f"CAST(sum(('0x' || substr(md5({_encoded_sql(cols)}), 1, 15))::BIGINT) AS VARCHAR) AS digest FROM {src} GROUP BY ALL)")


D3_FP = [(c, c not in ("country", "year", "iso_code")) for c in st.D3_COLUMNS]


@register("dataset_fingerprint", W(D3C, fingerprint_sql("stg_d3", D3_FP, st.D3_KEY)))
def q_dataset_fingerprint(spark, sf):
    return changes.dataset_fingerprint(stagings(spark, sf)["d3"], st.D3_COLUMNS, st.D3_KEY)


@register("change_gate", W(D3C + [("fp", fingerprint_sql("stg_d3", D3_FP, st.D3_KEY))], """
SELECT 1 AS run, 'loaded' AS status, n_rows, digest FROM fp
UNION ALL SELECT 2, 'unchanged', n_rows, digest FROM fp"""))
def q_change_gate(spark, sf):
    store = TableStore(spark, scratch_path(spark, "gate"))
    d3 = stagings(spark, sf)["d3"].select(*st.D3_COLUMNS)
    first = pl.run_staging(store, "staging_d3", d3, st.D3_KEY)
    second = pl.run_staging(store, "staging_d3", d3.repartition(7), st.D3_KEY)
    fp = changes.dataset_fingerprint(d3, st.D3_COLUMNS, st.D3_KEY)
    runs = spark.createDataFrame([(1, first), (2, second)], "run int, status string")
    return changes.attach_scalar(runs, fp)


D3_DOUBLES = osql.D3_DOUBLES


@register("upsert_by_key", _snap_d3_sql(f"""
SELECT {', '.join(st.D3_COLUMNS)} FROM a_stg_d3 a WHERE NOT EXISTS (
  SELECT 1 FROM b_stg_d3 b WHERE b.country = a.country AND b.year = a.year)
UNION ALL SELECT {', '.join(st.D3_COLUMNS)} FROM b_stg_d3""", D3_DOUBLES))
def q_upsert_by_key(spark, sf):
    target = stagings(spark, sf, "until_1998")["d3"]
    batch = stagings(spark, sf, "from_1997")["d3"]
    store = TableStore(spark, scratch_path(spark, "upsert"))
    store.upsert("d3", target, st.D3_KEY)
    store.upsert("d3", batch, st.D3_KEY)
    return finish(store.read("d3").select(*st.D3_COLUMNS))


@register("append", _snap_d3_sql(f"""
SELECT {', '.join(st.D3_COLUMNS)} FROM a_stg_d3 a WHERE NOT EXISTS (
  SELECT 1 FROM b_stg_d3 b WHERE b.country = a.country AND b.year = a.year)
UNION ALL SELECT {', '.join(st.D3_COLUMNS)} FROM b_stg_d3""", D3_DOUBLES))
def q_append(spark, sf):
    # Deprecated entry point of the reference: an upsert against the existing table, here the plain plan.
    target = stagings(spark, sf, "until_1998")["d3"]
    return finish(changes.upsert_by_key(target, stagings(spark, sf, "from_1997")["d3"], st.D3_KEY).select(*st.D3_COLUMNS))


@register("initial_load", osql.e1_sql())
def q_initial_load(spark, sf):
    d1 = stagings(spark, sf)["d1"]
    store = TableStore(spark, scratch_path(spark, "initial"))
    store.upsert("d1", d1, st.D1_KEY)  # the table doesn't exist yet
    return finish(store.read("d1").select(*d1.columns))


U2_HASH = [("co2", True), ("methane", True), ("nitrous_oxide", True), ("population", True)]


@register("upsert_changed_only", _snap_d3_sql(f"""
, ah AS (SELECT country, year, co2, methane, nitrous_oxide, population, 'old' AS loaded_from,
                {osql.row_hash_sql(U2_HASH)} AS row_hash FROM a_stg_d3),
bh AS (SELECT country, year, co2, methane, nitrous_oxide, population, 'new' AS loaded_from,
              {osql.row_hash_sql(U2_HASH)} AS row_hash FROM b_stg_d3),
delta AS (SELECT * FROM bh WHERE NOT EXISTS (
  SELECT 1 FROM ah WHERE ah.country = bh.country AND ah.year = bh.year AND ah.row_hash = bh.row_hash))
SELECT * FROM ah WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.country = ah.country AND d.year = ah.year)
UNION ALL SELECT * FROM delta""".replace("\n, ah AS", "WITH ah AS", 1), ["co2", "methane", "nitrous_oxide", "population"]))
def q_upsert_changed_only(spark, sf):
    def hashed(d, tag):
        d = d.select("country", "year", "co2", "methane", "nitrous_oxide", "population", F.lit(tag).alias("loaded_from"))
        return d.withColumn("row_hash", fx.row_hash(d, ["co2", "methane", "nitrous_oxide", "population"]))
    target = hashed(stagings(spark, sf, "until_1998")["d3"], "old")
    batch = hashed(stagings(spark, sf, "from_1997")["d3"], "new")
    return finish(changes.upsert_changed_only(target, batch, st.D3_KEY))


def _insert_if_absent_sql():
    a = osql.star_ctes("a_", "until_1998")
    full_c1, d1 = osql.stage_d1_ctes()
    full_c2, d2 = osql.stage_d2_book_ctes()
    full_c3, d3 = osql.stage_d3_ctes()
    ctes = a + full_c1 + full_c2 + full_c3 + [(n, s) for n, s in osql.dims_ctes("", d1, d2, d3)
                                              if n == "loc_cand"]
    keys = osql.LOC_KEY.split(", ")
    ns = " AND ".join(f"c.{k} IS NOT DISTINCT FROM o.{k}" for k in keys)
    body = f"""
, new_rows AS (SELECT * FROM loc_cand c WHERE NOT EXISTS (SELECT 1 FROM a_dim_location o WHERE {ns}))
SELECT location_id, {osql.LOC_KEY} FROM a_dim_location
UNION ALL
SELECT CAST((SELECT coalesce(max(location_id), 0) FROM a_dim_location)
            + row_number() OVER (ORDER BY {osql.LOC_ORDER}) AS INTEGER), {osql.LOC_KEY} FROM new_rows"""
    return R(W(ctes, body.replace("\n, new_rows AS", "WITH new_rows AS", 1)), ["latitude", "longitude"])


@register("insert_if_absent", _insert_if_absent_sql())
def q_insert_if_absent(spark, sf):
    old = dim_star(spark, sf, "until_1998")["dim_location"]
    s = stagings(spark, sf)
    cand = sk.location_candidates(s["d1"], s["d2"], s["d3"])
    return finish(changes.insert_if_absent(old, cand, sk.LOCATION_KEY, "location_id")
                  .select("location_id", *sk.LOCATION_KEY))


# ------------------------------------------------------------------ E6
def _pipeline_sql():
    parts = [f"SELECT 'staging_d{i}' AS table_name, count(*) AS n_rows FROM stg_d{i}" for i in (1, 2, 3)]
    parts += [f"SELECT '{n}', count(*) FROM {n}" for n in sk.STAR_SCHEMAS]
    return osql.star_sql(" UNION ALL ".join(parts))


@register("run_pipeline", _pipeline_sql())
def q_run_pipeline(spark, sf):
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    inputs = pl.driver_inputs(spark, sf)
    first = pl.run_pipeline(spark, inputs, store)
    second = pl.run_pipeline(spark, inputs, store)
    assert set(first.values()) == {"loaded"} and set(second.values()) == {"unchanged"}, (first, second)
    return pl.table_counts(store, ["staging_d1", "staging_d2", "staging_d3", *sk.STAR_SCHEMAS])


# ------------------------------------------------------------- W1, J7
@register("group_transform", _imp_sql(D1C, "d1_ren", ["concentration_pm10"], [["city"]],
                                      "country, city, year, concentration_pm10", ["year", "concentration_pm10"]))
def q_group_transform(spark, sf):
    # The group's mean on every row, a hot group over several tasks, then I1 by it.
    df = impute.group_transform(renamed_d1(spark, sf), ["city"], {"mean": ("mean", "concentration_pm10")})
    value = F.coalesce("concentration_pm10", F.when(F.col("city").isNotNull(), F.col("mean")))
    return finish(df.select("country", "city", "year", value.alias("concentration_pm10")))


@register("lateral_join", osql.star_sql(
    "SELECT time_id, location_id, src, v_co2, v_pct FROM (" + " UNION ALL ".join(
        f"SELECT time_id, location_id, '{n}' AS src, CAST({v} AS DOUBLE) AS v_co2, CAST({c} AS DOUBLE) AS v_pct "
        f"FROM d3_tl WHERE {v} IS NOT NULL" for n, v, c in reshape.EMISSION_SOURCES) + ")", ["v_co2", "v_pct"]))
def q_lateral_join(spark, sf):
    # JOIN LATERAL (VALUES ...) over outer columns becomes a generator in
    # the same stage: inline(array(struct(...))), no join at all.
    s = dim_star(spark, sf)
    d3 = sk.join_location_national(sk.join_time_by_year(stagings(spark, sf)["d3"], s["dim_time"]), s["dim_location"])
    return finish(reshape.unpivot_emission_pairs(d3, ["time_id", "location_id"]))
