"""Landed raw inputs derived from the driver tables.

The driver tables have no nulls, duplicates, junk text or dash-year ranges,
so the raw inputs of the three staging jobs are derived from them by one
query each, with gaps and junk injected by fixed arithmetic on the keys
(never by dropping rows). The same text runs in Spark and, through
``as_duckdb``, in the SQL oracle, so both sides start from equal inputs.
Every row of lineitem (d1), orders (d2) and lineitem grouped by customer and
year (d3) is used, so the work grows with the tables.

Stand-ins: country = nation (d1, d2) or customer (d3); city = supplier (d1)
or customer (d2); year = order year (d3 shifted by -15 so that the
``year > 1980`` filter has rows to drop); six sources = the six part types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.sources.driver import SNAPSHOTS, load, run_sql

# d1: station readings, one row per lineitem. (l_orderkey, l_linenumber) is
# not unique in the driver's lineitem; the file-order stand-in is an ordered
# struct of all of its columns, so rows that tie on it are equal. ORDINAL(...)
# stands for each engine's row value (``run_sql``, ``as_duckdb``).
RAW_AIR_QUALITY_SQL = """
SELECT
  ORDINAL(l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
          l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate) AS _ord,
  r.r_name AS who_region,
  'N' || CAST(n.n_nationkey AS STRING) AS iso3,
  n.n_name AS country_name,
  CASE WHEN s.s_suppkey % 10 = 3 THEN NULL
       WHEN s.s_suppkey % 5 = 0 THEN s.s_name || '/Centre'
       ELSE s.s_name END AS city,
  CASE WHEN l.l_orderkey % 17 = 0 THEN NULL
       ELSE CAST(CAST(year(o.o_orderdate) AS INT) AS DOUBLE) END AS year,
  CASE WHEN s.s_suppkey % 7 = 0 OR (l.l_orderkey + l.l_linenumber) % 5 = 0 THEN NULL
       ELSE l.l_quantity END AS pm10_concentration,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 7 = 1 THEN NULL
       ELSE CAST(CAST(floor(l.l_extendedprice / 1000) AS INT) AS DOUBLE) END AS pm25_concentration,
  CASE WHEN s.s_suppkey % 11 = 4 OR (l.l_orderkey + l.l_linenumber) % 3 = 2 THEN NULL
       ELSE CAST(CAST(round(l.l_discount * 100) AS INT) AS DOUBLE) END AS no2_concentration,
  CASE WHEN l.l_orderkey % 4 = 0 THEN NULL ELSE CAST(l.l_linenumber AS DOUBLE) END AS pm10_tempcov,
  CASE WHEN s.s_suppkey % 6 = 1 THEN NULL
       ELSE CAST(CAST(round(l.l_tax * 100) AS INT) AS DOUBLE) END AS pm25_tempcov,
  CASE WHEN l.l_linenumber = 3 THEN NULL ELSE CAST(l.l_orderkey % 10 AS DOUBLE) END AS no2_tempcov,
  CASE l.l_returnflag WHEN 'A' THEN 'Urban' WHEN 'N' THEN 'Suburban' ELSE 'Rural' END AS type_of_stations,
  CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS population,
  CASE WHEN l.l_orderkey % 23 = 0 THEN 'n/a'
       ELSE CAST(s.s_suppkey % 90 AS STRING) || '.25' END AS latitude,
  CAST(s.s_nationkey * 7 - 80 AS STRING) AS longitude,
  'ref' AS reference,
  'http://example.invalid/' || CAST(s.s_suppkey AS STRING) AS web_link
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# d2: source-apportionment studies, one row per order (safe column names;
# the raw headers are applied in Spark by ``BOOK_HEADERS``/``STUDIES_HEADERS``).
RAW_APPORTIONMENT_SQL = """
SELECT
  o.o_orderkey AS _ord,
  CASE WHEN o.o_orderkey % 11 = 0 THEN '????'
       WHEN o.o_orderkey % 5 = 0 THEN '-'
       WHEN o.o_orderkey % 13 = 0 THEN NULL
       WHEN o.o_orderkey % 7 = 0 THEN CAST(CAST(year(o.o_orderdate) AS INT) AS STRING)
       WHEN o.o_orderkey % 17 = 0 THEN 'x-' || CAST(CAST(year(o.o_orderdate) AS INT) + 1 AS STRING)
       WHEN o.o_orderkey % 19 = 0 THEN CAST(CAST(year(o.o_orderdate) AS INT) AS STRING) || '.0'
       ELSE CAST(CAST(year(o.o_orderdate) AS INT) AS STRING) || '-'
            || CAST(CAST(year(o.o_orderdate) AS INT) + 2 AS STRING) END AS study_year,
  n.n_name AS country,
  CASE WHEN c.c_custkey % 10 = 0 THEN c.c_name || '/Est' ELSE c.c_name END AS city,
  CASE WHEN o.o_orderkey % 31 = 0 THEN 'unknown'
       ELSE CAST(CAST(year(o.o_orderdate) AS INT) AS STRING) END AS yr,
  c.c_mktsegment AS methodology,
  'Author ' || CAST(o.o_custkey % 37 AS STRING) AS reference_author,
  o.o_orderpriority AS site_typology,
  'N' || CAST(n.n_nationkey AS STRING) AS iso3,
  r.r_name AS region,
  CASE WHEN o.o_orderkey % 23 = 0 THEN NULL
       ELSE 'Q' || CAST(CAST(quarter(o.o_orderdate) AS INT) AS STRING) END AS season,
  CASE WHEN o.o_orderkey % 6 = 0 THEN NULL WHEN o.o_orderkey % 29 = 0 THEN 'n.d.'
       ELSE CAST(CAST(floor(o.o_totalprice / 1000) AS INT) AS STRING) END AS pm10,
  CASE WHEN o.o_orderkey % 8 = 0 THEN ''
       ELSE CAST(CAST(floor(o.o_totalprice / 2500) AS INT) AS STRING) || '.5' END AS pm25,
  CAST(o.o_orderkey % 10 AS STRING) AS sea_salt,
  CASE WHEN o.o_orderkey % 9 = 4 THEN NULL ELSE CAST(o.o_custkey % 20 AS STRING) END AS dust,
  CAST(o.o_orderkey % 31 AS STRING) AS traffic,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL
       ELSE CAST(c.c_nationkey + o.o_orderkey % 4 AS STRING) END AS industry,
  CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE CAST(c.c_custkey % 15 AS STRING) END AS biomass,
  CASE WHEN c.c_nationkey % 5 = 2 THEN NULL
       ELSE CAST(o.o_orderkey % 7 AS STRING) || '.0' END AS other,
  CAST(CAST(floor(c.c_acctbal) AS INT) AS STRING) AS population,
  CAST(c.c_nationkey * 3 AS STRING) || '.5' AS latitude,
  CASE WHEN c.c_custkey % 50 = 7 THEN 'abc'
       ELSE CAST(c.c_custkey % 360 - 180 AS STRING) END AS longitude,
  lower(r.r_name) AS continent,
  'note' AS notes
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# d3: national emissions, one row per (customer, year); parts are quantities
# by part type, so total = sum of parts exactly before gaps are injected.
RAW_EMISSIONS_SQL = """
SELECT
  ck * 16 + (yr - 1975) AS _ord,
  country, iso_code, yr AS year,
  CASE WHEN (ck + yr) % 7 = 0 THEN NULL ELSE co2_all END AS co2,
  CASE WHEN (ck + yr) % 5 = 1 THEN NULL ELSE cement END AS cement_co2,
  CASE WHEN (ck + yr) % 6 = 2 THEN NULL ELSE coal END AS coal_co2,
  CASE WHEN ck % 13 = 5 THEN NULL ELSE consumption END AS consumption_co2,
  CASE WHEN (ck + yr) % 9 = 3 THEN NULL ELSE flaring END AS flaring_co2,
  gas AS gas_co2,
  CASE WHEN (ck * 3 + yr) % 8 = 4 THEN NULL ELSE oil END AS oil_co2,
  other_ind AS other_industry_co2,
  CASE WHEN (ck + yr) % 4 = 3 THEN NULL ELSE n_lines END AS methane,
  CASE WHEN ck % 11 = 2 THEN NULL ELSE s_ln END AS nitrous_oxide,
  CASE WHEN (ck + yr) % 10 = 6 THEN NULL WHEN (ck + yr) % 29 = 0 THEN 0.0
       ELSE n_lines * 1000.0 END AS population,
  CASE WHEN (ck + yr) % 12 = 7 THEN NULL ELSE n_orders * 1.0 END AS gdp,
  CASE WHEN (ck + yr) % 3 = 0 THEN NULL ELSE co2_all / 1000 END AS co2_per_capita,
  CASE WHEN (ck + yr) % 4 = 1 THEN NULL ELSE cement / 1000 END AS cement_co2_per_capita,
  CASE WHEN (ck + yr) % 5 = 2 THEN NULL ELSE coal / 1000 END AS coal_co2_per_capita,
  CASE WHEN (ck + yr) % 6 = 3 THEN NULL ELSE consumption / 1000 END AS consumption_co2_per_capita,
  CASE WHEN (ck + yr) % 7 = 4 THEN NULL ELSE flaring / 1000 END AS flaring_co2_per_capita,
  CASE WHEN (ck + yr) % 8 = 5 THEN NULL ELSE gas / 1000 END AS gas_co2_per_capita,
  CASE WHEN (ck + yr) % 9 = 6 THEN NULL ELSE oil / 1000 END AS oil_co2_per_capita,
  CASE WHEN (ck + yr) % 3 = 1 THEN NULL ELSE other_ind / 1000 END AS other_co2_per_capita,
  CASE WHEN (ck + yr) % 5 = 0 THEN NULL ELSE n_lines / 1000 END AS methane_per_capita,
  CASE WHEN (ck + yr) % 6 = 0 THEN NULL ELSE s_ln / 1000 END AS nitrous_oxide_per_capita
FROM (
  SELECT c.c_custkey AS ck, c.c_name AS country,
         'N' || CAST(c.c_nationkey AS STRING) AS iso_code,
         CAST(year(o.o_orderdate) AS INT) - 15 AS yr,
         sum(l.l_quantity) AS co2_all,
         sum(CASE WHEN p.p_type = 'STANDARD' THEN l.l_quantity ELSE 0.0 END) AS cement,
         sum(CASE WHEN p.p_type = 'ECONOMY' THEN l.l_quantity ELSE 0.0 END) AS coal,
         sum(CASE WHEN p.p_type = 'MEDIUM' THEN l.l_quantity ELSE 0.0 END) AS flaring,
         sum(CASE WHEN p.p_type = 'PROMO' THEN l.l_quantity ELSE 0.0 END) AS gas,
         sum(CASE WHEN p.p_type = 'LARGE' THEN l.l_quantity ELSE 0.0 END) AS oil,
         sum(CASE WHEN p.p_type = 'SMALL' THEN l.l_quantity ELSE 0.0 END) AS other_ind,
         CAST(sum(CAST(round(l.l_tax * 100) AS INT)) AS DOUBLE) AS consumption,
         CAST(count(*) AS DOUBLE) AS n_lines,
         CAST(count(DISTINCT o.o_orderkey) AS DOUBLE) AS n_orders,
         CAST(sum(l.l_linenumber) AS DOUBLE) AS s_ln
  FROM {lineitem} l
  JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {part} p ON l.l_partkey = p.p_partkey
  GROUP BY c.c_custkey, c.c_name, c.c_nationkey, CAST(year(o.o_orderdate) AS INT) - 15
) t
"""

# Raw headers of the two d2 sheets (safe name -> header as landed).
BOOK_HEADERS = {
    "study_year": "study_year", "country": "Country", "city": "City", "yr": "Year",
    "methodology": "Methodology", "reference_author": "Reference Author",
    "site_typology": "Site Typology", "iso3": "ISO3", "region": "Region", "season": "Season",
    "pm10": "PM10", "pm25": "PM2.5", "sea_salt": "Sea Salt", "dust": "Dust",
    "traffic": "Traffic", "industry": "Industry", "biomass": "Biomass", "other": "Other",
    "population": "Population", "latitude": "Latitude", "longitude": " Longitude ",
    "notes": "Notes",
}
STUDIES_HEADERS = {
    "city": "Site Location", "population": "Population estimate *", "country": "Country",
    "iso3": "ISO 3 code", "region": "Country Region", "continent": "continent",
    "latitude": "Latitude", "longitude": "Longitude", "site_typology": "Site typology",
    "pm10": "PM10 µgm-3 *", "pm25": "PM2.5 µgm-3 *", "methodology": "Methodology",
    "reference_author": "Reference author", "study_year": "Reference year", "yr": "Study year",
    "season": "Season", "sea_salt": "SEA SALT%", "dust": "DUST%", "traffic": "TRAFFIC%",
    "industry": "INDUSTRY%", "biomass": "BIOM. BURN./RES.%",
    "other": "OTHER (unspecified-human origin)%",
}


def raw_air_quality(spark: SparkSession, sf_dir: str, snapshot: str | None = None) -> DataFrame:
    return run_sql(spark, sf_dir, RAW_AIR_QUALITY_SQL, snapshot)


def _with_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    return df.select("_ord", *[F.col(k).alias(v) for k, v in headers.items()])


def raw_apportionment_book(spark: SparkSession, sf_dir: str, snapshot: str | None = None) -> DataFrame:
    return _with_headers(run_sql(spark, sf_dir, RAW_APPORTIONMENT_SQL, snapshot), BOOK_HEADERS)


def raw_apportionment_studies(spark: SparkSession, sf_dir: str, snapshot: str | None = None) -> DataFrame:
    return _with_headers(run_sql(spark, sf_dir, RAW_APPORTIONMENT_SQL, snapshot), STUDIES_HEADERS)


def customer_years(spark: SparkSession, sf_dir: str, snapshot: str | None = None) -> DataFrame:
    """The rows of the inner query of ``RAW_EMISSIONS_SQL``. As written, each
    line crosses the network for its order, its customer, its part and its
    group, under ever wider rows. Here lines meet their part, are summed per
    order, and orders are summed per customer and year before a customer's
    names are joined: the same sums, and n_orders is the same for each copy of
    a customer's row."""
    filters = SNAPSHOTS[snapshot]

    def table(name: str) -> DataFrame:
        df = load(spark, sf_dir, name)
        return df.filter(filters[name]) if name in filters else df
    qty, kinds = F.col("l_quantity"), {"cement": "STANDARD", "coal": "ECONOMY", "flaring": "MEDIUM", "gas": "PROMO", "oil": "LARGE", "other_ind": "SMALL"}
    lines = table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.round(F.col("l_tax") * 100).cast("int").alias("tax"))
    lines = lines.where("l_orderkey IS NOT NULL").join(table("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    sums = ["co2_all", *kinds, "consumption", "n_lines", "s_ln"]
    of_order = lines.groupBy("l_orderkey").agg(
        F.sum(qty).alias("co2_all"), *[F.sum(F.when(F.col("p_type") == kind, qty).otherwise(F.lit(0.0))).alias(c) for c, kind in kinds.items()],
        F.sum("tax").alias("consumption"), F.count(F.lit(1)).alias("n_lines"), F.sum("l_linenumber").alias("s_ln"))
    orders = table("orders").select("o_orderkey", "o_custkey", (F.year("o_orderdate").cast("int") - 15).alias("yr"))
    total = [F.sum(c).alias(c) for c in sums]
    once = of_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey", "o_custkey", "yr").agg(*total)
    of_year = once.groupBy("o_custkey", "yr").agg(*total, F.count(F.lit(1)).alias("n_orders"))
    customers = table("customer").select("c_custkey", "c_name", "c_nationkey")
    whole = of_year.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey", "c_name", "c_nationkey", "yr").agg(*total, F.max("n_orders").alias("n_orders"))
    return whole.select(F.col("c_custkey").alias("ck"), F.col("c_name").alias("country"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("iso_code"), "yr",
                        "co2_all", *kinds, *[F.col(c).cast("double").alias(c) for c in ("consumption", "n_lines", "n_orders", "s_ln")])


def raw_emissions(spark: SparkSession, sf_dir: str, snapshot: str | None = None) -> DataFrame:
    """``RAW_EMISSIONS_SQL``, its inner query by ``customer_years``."""
    outer, _, _ = RAW_EMISSIONS_SQL.partition("FROM (")
    return spark.sql(outer + "FROM {years}", years=customer_years(spark, sf_dir, snapshot))


def land(df: DataFrame, name: str) -> DataFrame:
    """S1 for derived inputs: write the raw frame once as the landed file
    (a table in the shared folder) and read it back, so a staging job that
    reads its input twice (cell aggregate, join back) scans a file instead
    of recomputing the derivation."""
    from airshed.session import materialize
    return materialize(df, f"landing_{name}")
