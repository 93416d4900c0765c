"""What a job leaves on the disks while it runs, and what it sends."""

import os

import numpy as np
from pyspark.sql import functions as F

from airshed.operators import changes, impute
from airshed.plans import catalog_star as cs
from airshed.plans import star as sk
from airshed.session import SHUFFLES_GO, materialize
from airshed.sources import driver_landing as dl
from airshed.sources.driver import run_sql


def shuffle_bytes(spark):
    jvm = spark.sparkContext._jvm
    dirs = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(at, f)) for d in dirs for at, _, files in os.walk(d) for f in files if f.startswith("shuffle_") and f.endswith(".data"))


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_bytes(spark), spark.conf.get(SHUFFLES_GO, None)
    out = materialize(spark.range(200_000).groupBy((F.col("id") * 7919 % 150_000).alias("k")).agg(F.sum("id").alias("s")), "sums")
    assert shuffle_bytes(spark) <= before and out.count() == 150_000
    assert spark.conf.get(SHUFFLES_GO, None) == setting


def odd_rows(spark, n=400):
    rng = np.random.default_rng(5)
    pick = lambda values: None if rng.random() < 0.15 else values[rng.integers(len(values))]
    rows = [(i, pick("abc"), pick("pqrstu"), pick([2001, 2002, 2003]), *[None if rng.random() < 0.5 else float(rng.normal(10, 3)) for _ in range(3)]) for i in range(n)]
    return spark.createDataFrame(rows, "id int, country string, city string, year int, a double, b double, c double")


def test_chains_by_a_key_equal_windows_and_shuffle_once(spark):
    df = odd_rows(spark)
    specs = [(["a"], [["city", "year"], ["country", "year"], ["country"]]), (["b", "c"], [["city", "year"], ["city"], ["country", "year"], ["country"]])]
    plain = sorted(impute.impute_many(df, specs).collect())
    by = impute.impute_many(df, specs, by=["city"])
    assert sorted(by.collect()) == plain
    window = sorted(impute.impute_many(df, specs, "window").collect())
    assert [r[:4] for r in plain] == [r[:4] for r in window] and np.allclose([[np.nan if v is None else v for v in r[4:]] for r in plain], [[np.nan if v is None else v for v in r[4:]] for r in window], equal_nan=True)
    assert impute._passes(specs) == [(["city", "year"], ["a", "b", "c"]), (["city"], ["b", "c"]), (["country", "year"], ["a", "b", "c"]), (["country"], ["a", "b", "c"])]


def test_cells_by_a_key_add_no_exchange(spark, monkeypatch):
    plans = []
    plain = impute._coarse_fills
    monkeypatch.setattr(impute, "_coarse_fills", lambda cells, *rest: plans.append(cells._jdf.queryExecution().executedPlan().toString()) or plain(cells, *rest))
    df = odd_rows(spark)
    assert sorted(impute.impute_many(df, [(["a", "b"], [["city", "year"], ["city"]])], by=["city"]).collect()) == sorted(impute.impute_many(df, [(["a", "b"], [["city", "year"], ["city"]])]).collect())
    assert plans[0].count("Exchange hashpartitioning") == 1


def twice(spark, tmp_path):
    """Tables with repeated keys and nulls."""
    day = "TIMESTAMP '1997-03-01 00:00:00'"
    lines = [f"({o}, {p}, {s}, {k}, CAST({q} AS DOUBLE), {x}D, 0.05D, CAST({t} AS DOUBLE), 'A', 'O', {day})" for o, p, s, k, q, x, t in
             [(1, 1, 1, 1, 3.0, 9.0, 0.02), (1, 2, 1, 2, "NULL", 9.0, "NULL"), (2, 1, 1, 1, 5.0, 9.0, 0.04), (2, 1, 1, 1, 5.0, 9.0, 0.04), ("NULL", 1, 1, 1, 7.0, 9.0, 0.01), (3, "NULL", 1, 3, 2.0, 9.0, 0.03), (3, 3, 1, 4, 2.0, 9.0, 0.03)]]
    tables = {
        "lineitem": f"SELECT * FROM VALUES {', '.join(lines)} AS t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)",
        "orders": f"SELECT * FROM VALUES (1, 1, {day}), (2, 1, {day}), (2, 1, {day}), (3, 2, CAST(NULL AS TIMESTAMP)), (NULL, 1, {day}) AS t(o_orderkey, o_custkey, o_orderdate)",
        "customer": "SELECT * FROM VALUES (1, 'One', 4), (1, 'One', 4), (1, 'Uno', 5), (2, 'Two', NULL) AS t(c_custkey, c_name, c_nationkey)",
        "part": "SELECT * FROM VALUES (1, 'STANDARD'), (2, 'PROMO'), (3, NULL), (3, 'LARGE') AS t(p_partkey, p_type)"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_emissions_are_landed_with_the_rows_of_their_sql(spark, tmp_path):
    d = twice(spark, tmp_path)
    want, got = run_sql(spark, d, dl.RAW_EMISSIONS_SQL), dl.raw_emissions(spark, d)
    assert want.schema == got.schema and want.count() == 3
    assert sorted(map(str, want.collect())) == sorted(map(str, got.collect()))


def test_a_staged_source_keeps_no_raw_input(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(dl, "land", lambda df, name: made.append(materialize(df, name)) or made[-1])
    monkeypatch.setitem(cs._RAW, "d3", lambda spark, sf, snapshot: spark.range(5).toDF("k"))
    monkeypatch.setitem(cs._STAGE, "d3", lambda raw: raw.groupBy((F.col("k") % 2).alias("k")).count())
    (tmp_path / "x").mkdir()
    assert cs.staged(spark, str(tmp_path), "d3").count() == 2
    assert len(made) == 1 and not os.path.exists(made[0]._written.removeprefix("file:"))


def test_a_first_batch_meets_no_empty_table(spark):
    batch = spark.createDataFrame([(1, 2, 3, 0.5, "h")], sk.STAR_SCHEMAS["fact_source_apportionment"][0])
    plan = changes.upsert_changed_only(sk.empty_table(spark, "fact_source_apportionment"), batch, ["time_id", "location_id", "source_id"], on_duplicate="defer")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString() and plan.collect() == batch.collect()
