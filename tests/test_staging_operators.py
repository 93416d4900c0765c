"""Hand-written fixtures of FIXTURES.md §3 for shaping, imputation,
reshaping and aggregation."""

import pytest
from pyspark.sql import functions as F

from airshed import functions as fx
from airshed.operators import dedupe, impute, reshape, shape


def _key(t):
    return tuple((x is None, str(x)) for x in t)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


@pytest.mark.parametrize("method", ["cells", "window"])
def test_impute_two_levels_uses_filled_values(spark, method):
    df = spark.createDataFrame([(1, "A", "c1", 10.0), (2, "A", "c1", None), (3, "A", "c2", None),
                                (4, "A", "c3", 40.0), (5, "B", "c4", None)], "id int, country string, city string, v double")
    out = impute.impute_chain(df, ["v"], [["city"], ["country"]], method)
    got = dict(rows(out, "id", "v"))
    assert got == {1: 10.0, 2: 10.0, 3: 20.0, 4: 40.0, 5: None}


@pytest.mark.parametrize("method", ["cells", "window"])
def test_impute_null_key_keeps_observed_value(spark, method):
    df = spark.createDataFrame([(1, "A", None, 7.0), (2, "A", None, None), (3, "A", "c1", 1.0)],
                               "id int, country string, city string, v double")
    out = impute.impute_chain(df, ["v"], [["city"], ["country"]], method)
    got = dict(rows(out, "id", "v"))
    assert got[1] == 7.0 and got[2] == pytest.approx(4.0) and got[3] == 1.0


def test_impute_never_changes_non_null_cells(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 7).cast("string").alias("k"),
                                 F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") * 1.5).alias("v"))
    out = impute.impute_group_mean(df, ["v"], ["k"]).withColumnRenamed("v", "w")
    joined = df.join(out, "id").filter(F.col("v").isNotNull())
    assert joined.filter(F.col("v") != F.col("w")).count() == 0


def test_balance_fill(spark):
    parts = ["p1", "p2", "p3", "p4", "p5", "p6"]
    data = [(1, None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0),
            (2, 21.0, None, 2.0, 3.0, 4.0, 5.0, 6.0),
            (3, 21.0, None, None, 3.0, 4.0, 5.0, 6.0),
            (4, 5.0, None, 2.0, 3.0, 4.0, 5.0, 6.0)]
    df = spark.createDataFrame(data, "id int, total double, " + ", ".join(f"{p} double" for p in parts))
    out = {r["id"]: r for r in impute.balance_fill_single_missing(df, "total", parts).collect()}
    assert out[1]["total"] == 21.0
    assert out[2]["p1"] == 1.0
    assert out[3]["p1"] is None and out[3]["p2"] is None
    assert out[4]["p1"] == 5.0 - 20.0  # negative kept


def test_per_capita_and_share(spark):
    df = spark.createDataFrame([(10.0, 0.0, None, None, 0.0, 5.0)],
                               "co2 double, population double, co2_per_capita double, other_co2_per_capita double, "
                               "total double, part double")
    pc = impute.derive_per_capita(df, ["co2_per_capita", "other_co2_per_capita"]).first()
    assert pc["co2_per_capita"] is None and pc["other_co2_per_capita"] is None
    pct = impute.derive_share_pct(df, ["part"], "total").first()
    assert pct["part_pct"] is None


def test_dash_years(spark):
    cases = [("2010-2012", [2010, 2012]), ("2010.0", [2010]), ("-", [None]), ("????", [None]), ("", [None]),
             (None, [None]), ("x-2011", [2011]), ("-2010", [2010]), ("inf", [None]), ("2010d", [None]),
             ("2_010", [2010]), ("2__010", [None])]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, study_year string")
    out = reshape.explode_dash_years(df, "study_year").collect()
    got = {}
    for r in out:
        got.setdefault(r["i"], []).append(r["study_year"])
    for i, (_, want) in enumerate(cases):
        assert sorted(got[i], key=lambda x: (x is None, x)) == want, cases[i]


def test_collapse_and_first_text(spark):
    df = spark.createDataFrame([(1, "k", 2010, "", 1.0), (2, "k", 2011, "EU", 3.0)],
                               "_ord int, key string, study_year int, region string, v double")
    out = dedupe.collapse_duplicates(df, ["key"], ["study_year", "v"], ["region"]).first()
    assert out["region"] == "" and out["v"] == 2.0
    assert int(out["study_year"]) == 2010  # 2010.5 truncated by the int conform


def test_distinct_concat_in_first_appearance_order(spark):
    df = spark.createDataFrame([(1, "k", "b"), (2, "k", "a"), (3, "k", None), (4, "k", "b"), (5, "z", None)],
                               "_ord int, key string, m string")
    out = dict(rows(dedupe.agg_distinct_concat(df, ["key"], ["m"]), "key", "m"))
    assert out == {"k": "b + a", "z": ""}


def test_dedupe_keep_first_null_keys_equal(spark):
    df = spark.createDataFrame([(3, None, 1), (1, None, 2), (2, "a", 3)], "_ord int, k string, v int")
    out = rows(dedupe.dedupe_keep_first(df, ["k"]), "k", "v")
    assert out == sorted([(None, 2), ("a", 3)], key=_key)


def test_unpivot_pairs_drop_null_value_keep_null_share(spark):
    df = spark.createDataFrame([(1, None, 1.0, 5.0, None)], "id int, coal_co2 double, coal_co2_pct double, "
                                                             "gas_co2 double, gas_co2_pct double")
    out = reshape.unpivot_emission_pairs(df, ["id"], [("coal", "coal_co2", "coal_co2_pct"),
                                                      ("gas", "gas_co2", "gas_co2_pct")]).collect()
    assert [(r["src"], r["v_co2"], r["v_pct"]) for r in out] == [("gas", 5.0, None)]


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, None)], "id int, a double, b double")
    long = reshape.unpivot_source_shares(df, ["id"], [("a", "a"), ("b", "b")])
    back = long.groupBy("id").pivot("src", ["a", "b"]).agg(F.first("val"))
    assert rows(back, "id", "a", "b") == rows(df, "id", "a", "b")


def test_alias_collision_coalesces(spark):
    df = spark.createDataFrame([(None, 2.0), (1.0, 3.0)], "`pm2.5` double, pm25 double")
    out = shape.alias_columns(df, {"pm2.5": "concentration_pm25", "pm25": "concentration_pm25"})
    assert out.columns == ["concentration_pm25"]
    assert [r[0] for r in out.collect()] == [2.0, 1.0]


def test_conform_and_text_functions(spark):
    df = spark.createDataFrame([("12", "1.5", None), ("abc", "inf", "nan"), (" 7.9 ", "2010d", "None")],
                               "i string, d string, t string")
    out = shape.conform_types(df, {"i": "int", "d": "double", "t": "string"}).collect()
    assert [(r["i"], r["d"], r["t"]) for r in out] == [(12, 1.5, ""), (0, None, ""), (7, None, "")]
    s = spark.createDataFrame([(None,), ("a/b",)], "c string")
    assert [r[0] for r in s.select(fx.to_string_nan("c")).collect()] == ["nan", "a/b"]
    assert [r[0] for r in s.select(fx.split_part("c")).collect()] == [None, "a"]


def test_delete_by_match_keeps_null_keys(spark):
    df = spark.createDataFrame([(" X ",), ("y",), (None,)], "city string")
    assert rows(shape.delete_by_match(df, "city", "x"), "city") == sorted([("y",), (None,)], key=_key)


def test_dedupe_keeps_one_of_tied_rows(spark):
    from airshed.operators import dedupe
    rows = [("a", 1, "y"), ("a", 1, "x"), ("a", 2, "w"), (None, 3, "n"), (None, 3, "m")]
    plain = spark.createDataFrame(rows, "k string, _ord long, v string")
    nested = plain.withColumn("_ord", F.struct(F.col("_ord").alias("a"), F.lit(0).alias("b")))
    for df in (plain, nested, plain.repartition(3)):
        assert sorted((str(r.k), r.v) for r in dedupe.dedupe_keep_first(df, ["k"]).collect()) == [("None", "m"), ("a", "x")]
        assert sorted((str(r.k), r.v) for r in dedupe.dedupe_keep_first_window(df, ["k"]).collect()) == [("None", "m"), ("a", "x")]


def test_station_order_holds_for_large_keys(spark):
    """Order keys of over 15 million, suppliers and parts past any packing."""
    from airshed.sources import driver_landing as dl
    line = spark.createDataFrame([(2 ** 40 + k, 300_000 + k, 17_000, 1, 1.0 + k, 1000.0, 0.0, 0.0, "A", "O") for k in range(3)],
                                 "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    tables = {"lineitem": line.withColumn("l_shipdate", F.current_timestamp()),
              "orders": line.select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("o_custkey"), F.current_date().alias("o_orderdate")),
              "supplier": spark.createDataFrame([(17_000, "s", 1)], "s_suppkey long, s_name string, s_nationkey int"),
              "nation": spark.createDataFrame([(1, "n", 1)], "n_nationkey int, n_name string, n_regionkey int"),
              "region": spark.createDataFrame([(1, "r")], "r_regionkey int, r_name string")}
    raw = spark.sql(dl.RAW_AIR_QUALITY_SQL.replace("ORDINAL(", "struct("), **tables)
    assert [r.pm10_tempcov is not None or r.l for r in raw.orderBy("_ord").select("pm10_tempcov", F.lit(True).alias("l")).collect()] == [True] * 3
    assert raw.select("_ord").distinct().count() == 3


def test_collapse_is_one_shuffle_without_a_join(spark):
    rows = [(1, "a", 1.5, None, "x"), (2, "a", None, None, None), (3, None, 2.0, 4.0, None), (4, None, 3.0, None, "y"), (5, "b", None, None, None)]
    df = spark.createDataFrame(rows, "_ord long, k string, m double, n double, t string")
    out = dedupe.collapse_duplicates(df, ["k"], ["m", "n"], ["t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got = {r.k: (r.m, r.n, r.t, r._ord) for r in out.collect()}
    assert got == {"a": (1.5, None, "x", 1), None: (2.5, 4.0, "y", 3), "b": (None, None, "", 5)}


def test_sieve_leaves_few_rows_a_key_and_the_same_first_rows(spark):
    data = [(k, None if (k == "n" and i == 7) else (i * 37) % 101 + 1, i % 3, f"v{i}") for k in ("a", "b", None, "n") for i in range(60)]
    plain = spark.createDataFrame(data + data[:5], "k string, _ord long, t int, v string")  # rows that come twice
    nested = plain.withColumn("_ord", F.struct("_ord", "t"))
    for df in (plain, nested, plain.repartition(3)):
        sieved = dedupe.sieve_first(df, ["k"])
        assert sieved.columns == df.columns and sieved.count() <= 8 < df.count()
        assert rows(dedupe.dedupe_keep_first(sieved, ["k"]), "k", "v") == rows(dedupe.dedupe_keep_first_window(df, ["k"]), "k", "v")
    text = plain.withColumn("_ord", F.col("_ord").cast("string"))
    assert dedupe.sieve_first(text, ["k"]).count() == text.count()
