"""Registered analytics queries: clustering (M1-M9, A10, W3, E7, E8) and
forecasting (W2, W4, R5, A11, M10-M12, E9)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from airshed import functions as fx
from airshed.operators import cluster as cl
from airshed.operators import forecast as fc
from airshed.plans import analytics as an
from airshed.plans import marts
from airshed.plans import oracle_sql as osql
from airshed.plans.catalog_star import SUM_BY_COUNTRY_SQL, star
from airshed.plans.queries import finish, register
from airshed.session import scratch_path
from airshed.sources.driver import load

CITY_SQL = """
SELECT location_id, country, city, coalesce(pm10, 0) AS pm10, coalesce(pm25, 0) AS pm25, coalesce(no2, 0) AS no2, latitude, longitude
FROM (SELECT location_id, avg(pm10) AS pm10, avg(pm25) AS pm25, avg(no2) AS no2 FROM fact_air_quality GROUP BY ALL) NATURAL JOIN dim_location"""


def _z(c: str, src: str) -> str:
    return (f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0)")


# ------------------------------------------------------------------ M1, M2
@register("standardise", osql.star_sql(
    f"SELECT location_id, {', '.join(_z(c, 'x') + ' AS ' + c + '_z' for c in marts.CITY_FEATURES)} "
    f"FROM ({CITY_SQL})", [f"{c}_z" for c in marts.CITY_FEATURES]))
def q_standardise(spark, sf):
    df = cl.standardise(an.city_features(star(spark, sf)), marts.CITY_FEATURES, suffix="_z")
    return finish(df.select("location_id", *[f"{c}_z" for c in marts.CITY_FEATURES]))


@register("log_standardise", osql.star_sql(
    "SELECT country, " + ", ".join(_z(f"{c}_log", "x") + f" AS {c}_log" for c in marts.COUNTRY_FEATURES)
    + " FROM (SELECT country, " + ", ".join(f"ln(1 + coalesce({c}, 0)) AS {c}_log" for c in marts.COUNTRY_FEATURES)
    + f" FROM ({SUM_BY_COUNTRY_SQL}))", [f"{c}_log" for c in marts.COUNTRY_FEATURES]))
def q_log_standardise(spark, sf):
    df = cl.log_standardise(an.country_features(star(spark, sf)), marts.COUNTRY_FEATURES, suffix="_log")
    return finish(df.select("country", *[f"{c}_log" for c in marts.COUNTRY_FEATURES]))


@register("log1p", osql.star_sql(
    "SELECT country, " + ", ".join(f"ln(1 + coalesce({c}, 0)) AS {c}_log1p" for c in marts.COUNTRY_FEATURES)
    + f" FROM ({SUM_BY_COUNTRY_SQL})", [f"{c}_log1p" for c in marts.COUNTRY_FEATURES]))
def q_log1p(spark, sf):
    df = an.country_features(star(spark, sf))
    return finish(df.select("country", *[fx.log1p(c).alias(f"{c}_log1p") for c in marts.COUNTRY_FEATURES]))


@register("fill_all_null_zero", osql.star_sql(
    "SELECT location_id, pm10, pm25, no2, coalesce(latitude, 0) AS latitude, "
    f"coalesce(longitude, 0) AS longitude FROM ({CITY_SQL})", ["pm10", "pm25", "no2", "latitude", "longitude"]))
def q_fill_all_null_zero(spark, sf):
    df = an.city_features(star(spark, sf), fill_all=True)
    return finish(df.select("location_id", "pm10", "pm25", "no2", "latitude", "longitude"))


@register("round_with_unit", osql.star_sql(
    "SELECT country, " + ", ".join(f"CAST(round_even(coalesce({c}, 0), 2) AS VARCHAR) || ' Mt' AS {c}_display"
                                   for c in marts.COUNTRY_FEATURES) + f" FROM ({SUM_BY_COUNTRY_SQL})"))
def q_round_with_unit(spark, sf):
    df = an.country_features(star(spark, sf))
    return df.select("country", *[fx.round_with_unit(c, fx.unit_for(c) or fx.UNIT_EMISSIONS).alias(f"{c}_display")
                                  for c in marts.COUNTRY_FEATURES])


# ------------------------------------------------------- M6, M7, W3, A10
EMB_SQL = "SELECT vec_id, label, embedding FROM embeddings"


def _emb(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", "label", cl.as_double_array("embedding").alias("x"))


SILHOUETTE_SQL = """
WITH pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
sums AS (SELECT a.vec_id, a.label, b.label AS c, sum(list_distance(a.x, b.x)) AS total, count(*) AS n FROM pts a, pts b GROUP BY ALL),
ab AS (SELECT vec_id, label, max(CASE WHEN c = label AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN c <> label THEN total / n END) AS b
       FROM sums GROUP BY vec_id, label),
s AS (SELECT vec_id, label, CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab)"""


@register("silhouette", SILHOUETTE_SQL + """
SELECT label, count(*) AS n_points, round(avg(silhouette), 6) AS mean_silhouette FROM s GROUP BY label""")
def q_silhouette(spark, sf):
    pts = cl.euclidean_silhouettes(_emb(spark, sf), "x", ["label"])
    return finish(pts.groupBy("label").agg(F.count(F.lit(1)).alias("n_points"),
                                           F.avg("silhouette_label").alias("mean_silhouette")))


@register("rank_clusters_by_mean", """
SELECT label, round(avg(embedding[1]), 6) AS mean_value,
       CAST(row_number() OVER (ORDER BY avg(embedding[1]) NULLS FIRST, label) AS INTEGER) AS rank
FROM embeddings GROUP BY label""")
def q_rank_clusters_by_mean(spark, sf):
    df = _emb(spark, sf).withColumn("x0", F.col("x")[0])
    return finish(cl.rank_clusters_by_mean(df, "label", "x0"))


@register("name_clusters", """
WITH r AS (SELECT label, CAST(row_number() OVER (ORDER BY avg(embedding[1]) NULLS FIRST, label) AS INTEGER) AS rank
           FROM embeddings GROUP BY label)
SELECT e.vec_id, e.label, 'Cluster ' || CAST(r.rank AS VARCHAR) AS cluster_name
FROM embeddings e JOIN r USING (label)""")
def q_name_clusters(spark, sf):
    df = _emb(spark, sf).withColumn("x0", F.col("x")[0])
    return cl.name_clusters(df, "label", "x0").select("vec_id", "label", "cluster_name")


@register("cluster_profile", osql.star_sql(
    "SELECT region AS cluster, count(*) AS size, "
    + ", ".join(f"avg({f}) AS {f}_mean, min({f}) AS {f}_min, max({f}) AS {f}_max" for f in marts.CITY_FEATURES)
    + f" FROM ({CITY_SQL}) c JOIN dim_location USING (location_id) GROUP BY region",
    [f"{f}_{s}" for f in marts.CITY_FEATURES for s in ("mean", "min", "max")]))
def q_cluster_profile(spark, sf):
    s = star(spark, sf)
    df = an.city_features(s).join(s["dim_location"].select("location_id", F.col("region").alias("cluster")),
                                  "location_id")
    return finish(cl.cluster_profile(df, "cluster", marts.CITY_FEATURES))


# ------------------------------------------------------- M3-M5, M8, M9, E7, E8
def _points_sql(place: str) -> tuple[str, list[str]]:
    """(SQL of id, raw features and x0.., raw feature names) of the places."""
    if place == "city":
        names, src = marts.CITY_FEATURES, f"SELECT CAST(location_id AS VARCHAR) AS id, * FROM ({CITY_SQL})"
        scaled = [_z(c, "") for c in names]
    else:
        names = marts.COUNTRY_FEATURES
        src = f"SELECT country AS id, country, {', '.join(f'coalesce({c}, 0) AS {c}' for c in names)} FROM ({SUM_BY_COUNTRY_SQL})"
        scaled = [_z(f"ln(1 + {c})", "") for c in names]
    return f"SELECT *, {', '.join(f'{x} AS x{i}' for i, x in enumerate(scaled))} FROM ({src})", names


def _start_ctes(k: int, d: int = 3) -> list[tuple[str, str]]:
    """``f1`` to ``f<k>``: each the point farthest from the mean, then from all before it."""
    dims = range(d)
    x = ", ".join(f"x{i}" for i in dims)
    out = [("f0", f"SELECT {', '.join(f'avg(x{i}) AS m{i}' for i in dims)} FROM pts")]
    for j in range(1, k + 1):
        froms = ["f0"] if j == 1 else [f"f{n}" for n in range(1, j)]
        least = "least(" + ", ".join("(" + " + ".join(f"pow(p.x{i} - {f}.m{i}, 2)" for i in dims) + ")" for f in froms) + ")"
        near = "" if j == 1 else "WHERE far > 0"
        out.append((f"f{j}", f"SELECT {', '.join(f'x{i} AS m{i}' for i in dims)} FROM (SELECT {', '.join(f'p.x{i}' for i in dims)}, round({least}, 9) AS far "
                             f"FROM pts p, {', '.join(froms)}) {near} ORDER BY far DESC, {x} LIMIT 1"))
    return out


def _kmeans_ctes(k: int, d: int = 3) -> list[tuple[str, str]]:
    """Lloyd's rounds written out: centres ``c<k>_<round>`` from the starts, an
    empty cluster taking the farthest point of another, and the last
    assignment ``l<k>`` (id, cluster, x0..)."""
    dims = range(d)
    x, m = ", ".join(f"x{i}" for i in dims), ", ".join(f"m{i}" for i in dims)
    out = [(f"c{k}_0", " UNION ALL ".join(f"SELECT {j} AS j, {m} FROM f{j + 1}" for j in range(k)))]
    distance = " + ".join(f"pow(x{i} - m{i}, 2)" for i in dims)

    def assigned(n: int) -> str:
        return f"SELECT DISTINCT ON (id) id, j, {x}, {distance} AS far FROM pts, c{k}_{n} ORDER BY id, {distance}, j"
    for n in range(cl.ITERATIONS):
        out.append((f"a{k}_{n}", assigned(n)))
        spare = (f"SELECT *, row_number() OVER (ORDER BY far DESC, {x}) AS r FROM (SELECT DISTINCT ON (j) j AS of, {x}, round(far, 9) AS far FROM a{k}_{n} "
                 f"ORDER BY j, round(far, 9) DESC, {x}) WHERE far > 0")
        empty = f"SELECT *, row_number() OVER (ORDER BY j) AS r FROM c{k}_{n} WHERE j NOT IN (SELECT j FROM a{k}_{n})"
        out.append((f"c{k}_{n + 1}", f"SELECT j, {', '.join(f'avg(x{i}) AS m{i}' for i in dims)} FROM a{k}_{n} GROUP BY j UNION ALL "
                                     f"SELECT j, {', '.join(f'coalesce(x{i}, m{i})' for i in dims)} FROM ({empty}) LEFT JOIN ({spare}) USING (r)"))
    out.append((f"l{k}", f"SELECT id, j AS cluster, {x} FROM ({assigned(cl.ITERATIONS)})"))
    return out


def _silhouette_ctes(k: int, d: int = 3) -> list[tuple[str, str]]:
    """``s<k>``: one row (k, silhouette) of the labels ``l<k>``, all pairs."""
    far = "sqrt(" + " + ".join(f"pow(p.x{i} - q.x{i}, 2)" for i in range(d)) + ")"
    return [(f"d{k}", f"SELECT p.id, p.cluster, q.cluster AS g, count(*) AS n, sum({far}) AS total FROM l{k} p, l{k} q GROUP BY ALL"),
            (f"p{k}", f"SELECT id, max(CASE WHEN g = cluster AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN g <> cluster THEN total / n END) AS b FROM d{k} GROUP BY id"),
            (f"s{k}", f"SELECT {k} AS k, avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END) AS silhouette FROM p{k}")]


def _cluster_sql(place: str, ks: range, body: str, doubles: list[str] = ()) -> str:
    """``body`` over pts, l<k> and, for several k, s<k> and best (k, silhouette, chosen)."""
    ctes = [("pts", _points_sql(place)[0]), *_start_ctes(max(ks))]
    for k in ks:
        ctes += _kmeans_ctes(k) + (_silhouette_ctes(k) if len(ks) > 1 else [])
    if len(ks) > 1:
        ctes += [("tried", " UNION ALL ".join(f"SELECT * FROM s{k}" for k in ks)),
                 ("best", "SELECT k, silhouette, row_number() OVER (ORDER BY silhouette DESC, k) = 1 AS chosen FROM tried"),
                 ("chosen", " UNION ALL ".join(f"SELECT id, cluster FROM l{k} WHERE {k} = (SELECT k FROM best WHERE chosen)" for k in ks))]
    return osql.star_sql("WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in ctes) + " " + body, list(doubles))


def _named_sql(labels: str, feature: str) -> str:
    """``labels`` (id, cluster) with the places' columns and cluster_name."""
    return (f"(SELECT p.*, l.cluster, 'Cluster ' || CAST(r.r AS VARCHAR) AS cluster_name FROM {labels} l JOIN pts p USING (id) "
            f"JOIN (SELECT cluster, row_number() OVER (ORDER BY avg({feature}), cluster) AS r FROM {labels} JOIN pts USING (id) GROUP BY cluster) r USING (cluster))")


def _profile_sql(labels: str, feature: str, names: list[str]) -> str:
    cells = ", ".join(f"avg({f}) AS {f}_mean, min({f}) AS {f}_min, max({f}) AS {f}_max" for f in names)
    return f"SELECT cluster_name, count(*) AS size, {cells} FROM {_named_sql(labels, feature)} GROUP BY cluster_name"


def _cells(names: list[str]) -> list[str]:
    return [f"{f}_{x}" for f in names for x in ("mean", "min", "max")]


def _city_points(spark, sf):
    df = cl.standardise(an.city_features(star(spark, sf)), marts.CITY_FEATURES, suffix="_z")
    return df.withColumn("x", cl.features_array([f"{c}_z" for c in marts.CITY_FEATURES], "x"))


def _country_points(spark, sf):
    df = cl.log_standardise(an.country_features(star(spark, sf)), marts.COUNTRY_FEATURES, suffix="_log")
    return df.withColumn("x", cl.features_array([f"{c}_log" for c in marts.COUNTRY_FEATURES], "x"))


@register("kmeans", _cluster_sql("country", range(4, 5), "SELECT id AS country, cluster FROM l4"))
def q_kmeans(spark, sf):
    return cl.kmeans(_country_points(spark, sf), "x", 4).select("country", "cluster")


@register("ward_clusters")
def q_ward_clusters(spark, sf):
    return cl.ward_clusters(_city_points(spark, sf), "x", 3).select("location_id", "cluster")


TRIED = range(2, cl.MAX_K + 1)


@register("choose_k_silhouette", _cluster_sql("city", TRIED, "SELECT k, silhouette, chosen FROM best", ["silhouette"]))
def q_choose_k_silhouette(spark, sf):
    return finish(cl.choose_k_silhouette(_city_points(spark, sf), "x")[0])


@register("cluster_cities")
def q_cluster_cities(spark, sf):
    # The named places with the profile of their cluster.
    places, profile = an.cluster_cities(star(spark, sf))
    return finish(places.join(profile, "cluster_name"))


@register("cluster_countries")
def q_cluster_countries(spark, sf):
    places, profile = an.cluster_countries(star(spark, sf))
    return finish(places.join(profile, "cluster_name"))


@register("cluster_city_table", _cluster_sql(
    "city", range(3, 4), f"SELECT country, city, latitude, longitude, pm10, pm25, no2, cluster, cluster_name FROM {_named_sql('l3', 'pm10')}",
    ["latitude", "longitude", *marts.CITY_FEATURES]))
def q_cluster_city_table(spark, sf):
    # M8 over three k-means clusters.
    named = cl.name_clusters(cl.kmeans(_city_points(spark, sf), "x", 3), "cluster", "pm10")
    return finish(an.cluster_city_table(named))


@register("cluster_country_table", _cluster_sql(
    "country", range(3, 4), f"SELECT country, co2, methane, nitrous, cluster, cluster_name, "
    + ", ".join(f"CAST(round_even({c}, 2) AS VARCHAR) || ' Mt' AS {c}_display" for c in marts.COUNTRY_FEATURES)
    + f" FROM {_named_sql('l3', 'co2')}", marts.COUNTRY_FEATURES))
def q_cluster_country_table(spark, sf):
    # M9 over three k-means clusters.
    named = cl.name_clusters(cl.kmeans(_country_points(spark, sf), "x", 3), "cluster", "co2")
    return finish(an.cluster_country_table(named))


@register("cluster_cities_kmeans", _cluster_sql("city", TRIED, _profile_sql("chosen", "pm10", marts.CITY_FEATURES), _cells(marts.CITY_FEATURES)))
def q_cluster_cities_kmeans(spark, sf):
    return finish(an.cluster_cities_kmeans(star(spark, sf))[2])


@register("cluster_countries_kmeans", _cluster_sql("country", TRIED, _profile_sql("chosen", "co2", marts.COUNTRY_FEATURES), _cells(marts.COUNTRY_FEATURES)))
def q_cluster_countries_kmeans(spark, sf):
    return finish(an.cluster_countries_kmeans(star(spark, sf))[2])


# ------------------------------------------------------------- forecasting
SERIES_SQL = """
SELECT * FROM (
  SELECT f.location_id, CAST(t.year AS INTEGER) AS year, 'pm10' AS pollutant, f.pm10 AS value
  FROM fact_air_quality f JOIN dim_time t ON f.time_id = t.time_id
  UNION ALL SELECT f.location_id, CAST(t.year AS INTEGER), 'pm25', f.pm25
  FROM fact_air_quality f JOIN dim_time t ON f.time_id = t.time_id
  UNION ALL SELECT f.location_id, CAST(t.year AS INTEGER), 'no2', f.no2
  FROM fact_air_quality f JOIN dim_time t ON f.time_id = t.time_id) WHERE value IS NOT NULL"""


@register("sort_series", osql.star_sql(f"SELECT location_id, year, pollutant, value FROM ({SERIES_SQL})", ["value"]))
def q_sort_series(spark, sf):
    return finish(an.air_series(star(spark, sf)).select("location_id", "year", "pollutant", "value")
                  .orderBy("pollutant", "location_id", "year"))


@register("split_last_observation", osql.star_sql(f"""
SELECT pollutant, location_id, year, value,
       CASE WHEN row_number() OVER (PARTITION BY pollutant, location_id ORDER BY year DESC) = 1
            THEN 'test' ELSE 'train' END AS role
FROM (SELECT *, count(*) OVER (PARTITION BY pollutant, location_id) AS n FROM ({SERIES_SQL}))
WHERE n >= 5""", ["value"]))
def q_split_last_observation(spark, sf):
    return finish(fc.split_last_observation(an.air_series(star(spark, sf)), ["pollutant", "location_id"])
                  .select("pollutant", "location_id", "year", "value", "role"))


@register("generate_horizon", osql.star_sql(f"""
WITH g AS (SELECT max(year) + 1 AS a FROM ({SERIES_SQL})),
k AS (SELECT DISTINCT pollutant, location_id FROM ({SERIES_SQL}))
SELECT k.pollutant, k.location_id, CAST(y.year AS INTEGER) AS year
FROM k, g, (SELECT unnest(range(g.a, 2027)) AS year FROM g) y"""))
def q_generate_horizon(spark, sf):
    from airshed.operators.changes import attach_scalar
    from airshed.operators.reshape import generate_horizon
    s = an.air_series(star(spark, sf))
    keys = s.select("pollutant", "location_id").distinct()
    keys = attach_scalar(keys, s.agg((F.max("year") + 1).alias("start_year")))
    return (generate_horizon(keys, "start_year", fc.END_YEAR, "year")
            .select("pollutant", "location_id", F.col("year").cast("int").alias("year")))


# The likelihood fit, written out: a coarse grid, then finer ones around the best pair.
def _series(spark, sf):
    """The series at the 6 decimals of every compare: engines differ in the
    last bits of a filled mean, and a search over a flat surface follows them."""
    return finish(an.air_series(star(spark, sf)))


def _grid_sql(points: int, axis: str) -> str:
    i = f"(SELECT unnest(range({points})) AS i)"
    return f"SELECT a.i * {points} + b.i AS idx, {axis.replace('#', 'a.i')} AS ph, {axis.replace('#', 'b.i')} AS th FROM {i} a, {i} b"


def _fit_ctes(src: str) -> list[tuple[str, str]]:
    """``fit`` (pollutant, location_id, ph, th, d_last, e_last, y_last) of the
    series ``src`` (pollutant, location_id, rn, v)."""
    key = "pollutant, location_id"
    reach, step = fc.REACH, fc.STEP
    out = [("diffs", f"SELECT {key}, rn, v, v - lag(v) OVER w AS d, lag(v) OVER w - lag(v, 2) OVER w AS p FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY rn)"),
           ("lists", f"""SELECT {key}, arg_max(v, rn) AS y_last, coalesce(arg_max(d, rn) FILTER (d IS NOT NULL), 0.0) AS d_last,
  coalesce(list({{'d': d, 'p': coalesce(p, 0.0::DOUBLE), 'e': 0.0::DOUBLE, 's': 0.0::DOUBLE, 'm': 0.0::DOUBLE, 'r': 0.0::DOUBLE, 'q': 0.0::DOUBLE}} ORDER BY rn) FILTER (d IS NOT NULL), []) AS l,
  count(*) AS n FROM diffs GROUP BY {key}"""),
           ("grid", _grid_sql(fc.COARSE, f"(CASE WHEN # = {fc.COARSE - 1} THEN {reach}::DOUBLE ELSE # * ({2 * reach}::DOUBLE / {fc.COARSE - 1}) - {reach}::DOUBLE END)")),
           ("around", _grid_sql(fc.FINE, f"(# - {fc.FINE // 2})::DOUBLE"))]
    # m is the variance of the last innovation, r that of the next, s the squares over theirs, q the product of all.
    error = "x.d - ph * x.p - th * a.e / a.m"
    start = "{'d': 0.0::DOUBLE, 'p': 0.0::DOUBLE, 'e': 0.0::DOUBLE, 's': 0.0::DOUBLE, 'm': 1.0::DOUBLE, 'r': (1 + 2 * ph * th + th * th) / (1 - ph * ph), 'q': 1.0::DOUBLE}"
    search = (f"list_reduce(list_concat([{start}], l), lambda a, x: {{'d': x.d, 'p': x.p, 'e': {error}, 's': a.s + ({error}) * ({error}) / a.r, "
              f"'m': a.r, 'r': 1 + th * th - th * th / a.r, 'q': a.q * a.r}})")

    def best(name: str, pairs: str) -> list[tuple[str, str]]:
        return [(f"{name}_all", f"SELECT {key}, n, idx, ph, th, {search} AS r FROM ({pairs})"),
                (name, f"SELECT DISTINCT ON ({key}) {key}, ph, th, r.e / r.m AS e_last FROM {name}_all ORDER BY {key}, (n - 1) * ln(greatest(r.s, {fc.LEAST!r}::DOUBLE)) + ln(r.q), idx")]
    out += best("fit0", f"SELECT {key}, l, n, idx, ph, th FROM lists, grid WHERE n >= 3")
    for k in range(fc.REFINEMENTS):
        place = "least(greatest(b.{0} + g.{0} * " + f"{step / 2 ** (k + 1)!r}::DOUBLE, -{fc.LIMIT}::DOUBLE), {fc.LIMIT}::DOUBLE) AS {{0}}"
        out += best(f"fit{k + 1}", f"SELECT b.pollutant, b.location_id, l, n, g.idx, {place.format('ph')}, {place.format('th')} "
                                   f"FROM fit{k} b JOIN lists USING ({key}), around g")
    out.append(("fit", f"SELECT {key}, y_last, coalesce(ph, 0.0) AS ph, coalesce(th, 0.0) AS th, CASE WHEN n >= 3 THEN d_last ELSE 0.0 END AS d_last, coalesce(e_last, 0.0) AS e_last "
                       f"FROM lists LEFT JOIN fit{fc.REFINEMENTS} USING ({key})"))
    return out


def _fitted_sql(src: str, body: str, doubles: list[str]) -> str:
    ctes = [("series", f"SELECT pollutant, location_id, year, round(value, 6) AS v, row_number() OVER (PARTITION BY pollutant, location_id ORDER BY year) AS rn, "
                       f"count(*) OVER (PARTITION BY pollutant, location_id) AS n FROM ({SERIES_SQL})"),
            ("learnt", src)] + _fit_ctes("learnt")
    return osql.star_sql("WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in ctes) + " " + body, doubles)


def _backtest_sql(body: str, doubles: list[str]) -> str:
    test = ("(SELECT s.pollutant, s.location_id, CAST(s.n AS INTEGER) AS n_points, s.v AS y_true, y_last + (ph * d_last + th * e_last) AS y_pred "
            f"FROM fit JOIN series s USING (pollutant, location_id) WHERE s.rn = s.n)")
    return _fitted_sql(f"SELECT pollutant, location_id, rn, v FROM series WHERE n >= {fc.MIN_POINTS_BACKTEST} AND rn < n", body.replace("BACKTEST", test), doubles)


# The dth step ahead adds phi**h times the first step: a running product, as the forecast makes it.
_FORECAST_BODY = f"""
, span AS (SELECT max(year) + 1 AS a FROM series),
ahead AS (SELECT pollutant, location_id, unnest(range(span.a, {fc.END_YEAR + 1})) AS year, span.a AS a, ph, ph * d_last + th * e_last AS first, y_last FROM fit, span)
SELECT pollutant, location_id, CAST(year AS INTEGER) AS year,
       y_last + list_sum(list_transform(range(year - a + 1), lambda h: first * pow(ph, h))) AS pred FROM ahead"""


def _forecast_sql(body: str, doubles: list[str]) -> str:
    return _fitted_sql("SELECT pollutant, location_id, rn, v FROM series", body, doubles)


@register("arima_backtest", _backtest_sql(
    "SELECT pollutant, location_id, n_points, y_true, y_pred, abs(y_true - y_pred) AS mae, sqrt(pow(y_true - y_pred, 2)) AS rmse FROM BACKTEST",
    ["y_true", "y_pred", "mae", "rmse"]))
def q_arima_backtest(spark, sf):
    return finish(fc.arima_backtest(_series(spark, sf)))


@register("mean_error_over_series", _backtest_sql(
    "SELECT pollutant, avg(abs(y_true - y_pred)) AS mean_mae, avg(sqrt(pow(y_true - y_pred, 2))) AS mean_rmse, count(*) AS n_series FROM BACKTEST GROUP BY pollutant",
    ["mean_mae", "mean_rmse"]))
def q_mean_error_over_series(spark, sf):
    return finish(fc.mean_error_over_series(fc.arima_backtest(_series(spark, sf))))


@register("abs_sqrt_error", _backtest_sql(
    "SELECT pollutant, location_id, abs(y_true - y_pred) AS mae, sqrt(pow(y_true - y_pred, 2)) AS rmse FROM BACKTEST", ["mae", "rmse"]))
def q_abs_sqrt_error(spark, sf):
    bt = fc.arima_backtest(_series(spark, sf))
    return finish(bt.select("pollutant", "location_id", fx.abs_error("y_true", "y_pred").alias("mae"),
                            fx.sqrt_sq_error("y_true", "y_pred").alias("rmse")))


@register("arima_forecast", _forecast_sql(_FORECAST_BODY, ["pred"]))
def q_arima_forecast(spark, sf):
    return finish(fc.arima_forecast(_series(spark, sf)))


@register("forecast_all_pollutants", _forecast_sql(
    f"{_FORECAST_BODY.replace('SELECT pollutant, location_id, CAST', ', preds AS (SELECT pollutant, location_id, CAST', 1)}) "
    "SELECT pollutant, count(DISTINCT location_id) AS n_series, count(*) AS n_years, avg(pred) AS mean_pred FROM preds GROUP BY pollutant", ["mean_pred"]))
def q_forecast_all_pollutants(spark, sf):
    # One job forecasts every pollutant.
    forecasts = fc.arima_forecast(_series(spark, sf))
    return finish(forecasts.groupBy("pollutant").agg(F.countDistinct("location_id").alias("n_series"), F.count(F.lit(1)).alias("n_years"),
                                                     F.avg("pred").alias("mean_pred")))


FIT_NAME = r"\b(diffs|lists|grid|around|fit(\d+(_all)?)?)\b"


def _forecast_with_errors_sql() -> str:
    """Both fits in one statement: that of the back-test under names of its own."""
    test = [(re.sub(FIT_NAME, r"bt_\g<0>", n), re.sub(FIT_NAME, r"bt_\g<0>", q)) for n, q in _fit_ctes("trained")]
    ctes = [("trained", f"SELECT pollutant, location_id, rn, v FROM series WHERE n >= {fc.MIN_POINTS_BACKTEST} AND rn < n")] + test
    errors = ("SELECT s.pollutant, avg(abs(v - p)) AS mean_mae, avg(sqrt(pow(v - p, 2))) AS mean_rmse, count(*) AS n_series FROM series s JOIN "
              "(SELECT pollutant, location_id, y_last + (ph * d_last + th * e_last) AS p FROM bt_fit) USING (pollutant, location_id) WHERE s.rn = s.n GROUP BY s.pollutant")
    body = _FORECAST_BODY.replace("SELECT pollutant, location_id, CAST", ", preds AS (SELECT pollutant, location_id, CAST", 1) + ")"
    more = ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in [*ctes, ("errors", errors)])
    return _forecast_sql(f", {more} {body} SELECT * FROM preds JOIN errors USING (pollutant)", ["pred", "mean_mae", "mean_rmse"])


@register("forecast_pollutants", _forecast_with_errors_sql())
def q_forecast_pollutants(spark, sf):
    # Forecasts with their pollutant's mean errors; the files are written beside.
    _, summary, forecasts = an.forecast_pollutants(_series(spark, sf), out=scratch_path(spark, "forecast-files"))
    return finish(forecasts.join(summary, "pollutant"))
