"""Keys, upserts, fingerprints and star loading (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from airshed.operators import changes
from airshed.plans import star as sk


def test_upsert_by_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "b2"), (3, "c")], "k int, v string")
    out = sorted(tuple(r) for r in changes.upsert_by_key(target, batch, ["k"]).collect())
    assert out == [(1, "a"), (2, "b2"), (3, "c")]
    twice = changes.upsert_by_key(changes.upsert_by_key(target, batch, ["k"]), batch, ["k"])
    assert sorted(tuple(r) for r in twice.collect()) == out
    dup = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(changes.DuplicateKeyError):
        changes.upsert_by_key(target, dup, ["k"])


def test_upsert_changed_only(spark):
    target = spark.createDataFrame([(1, "h1", "old"), (2, "h2", "old"), (3, None, "old")],
                                   "k int, row_hash string, tag string")
    batch = spark.createDataFrame([(1, "h1", "new"), (2, "h9", "new"), (3, None, "new"), (4, "h4", "new")],
                                  "k int, row_hash string, tag string")
    out = dict((r["k"], r["tag"]) for r in changes.upsert_changed_only(target, batch, ["k"]).collect())
    assert out == {1: "old", 2: "new", 3: "old", 4: "new"}


def test_insert_if_absent_null_safe(spark):
    target = spark.createDataFrame([(1, "FR", None)], "location_id int, country string, city string")
    cand = spark.createDataFrame([("FR", None), ("FR", "Paris"), ("DE", None)], "country string, city string")
    out = sorted(tuple(r) for r in changes.insert_if_absent(target, cand, ["country", "city"], "location_id").collect())
    assert out == [(1, "FR", None), (2, "DE", None), (3, "FR", "Paris")]


def test_surrogate_keys_are_consecutive_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x"))
    out = changes.assign_surrogate_key(df.repartition(5), "sid", ["x"], start=10).collect()
    pairs = sorted((r["x"], r["sid"]) for r in out)
    assert [s for _, s in pairs] == list(range(10, 5010))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_surrogate_keys_stay_distinct_at_size(spark, adaptive):
    """The counts and the rows come from one layout, so no reuse of an exchange is needed."""
    n = 2_000_000
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.exchange.reuse")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(0, n, 1, 7).select((F.col("id") * 7919 % n).alias("x"), F.concat(F.lit("payload "), F.col("id")).alias("p"))
        got = changes.assign_surrogate_key(df, "sid", ["x"]).agg(F.countDistinct("sid"), F.min("sid"), F.max("sid"), F.count(F.when(F.col("sid") != F.col("x") + 1, 1))).first()
        assert tuple(got) == (n, 1, n, 0)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_hash_text_keeps_every_bit(spark):
    from airshed import functions as fx
    values = [0.0, 1.0, -1.0, 5.0e-11, 9.0e-11, 5.01e-9, 5.04e-9, 1e30, 2e30, 0.1, 0.1 + 2 ** -56, 2.0 ** -1074, 1.7976931348623157e308, 2.0 ** 100, 2.0 ** 100 * (1 - 2 ** -53), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    text = [r[0] for r in df.select(fx.hash_text("v", df.schema["v"].dataType)).collect()]
    assert len(set(text)) == len(values)
    for v, t in zip(values, text, strict=True):
        if "p" in t:
            m, e = map(int, t.split("p"))
            assert m * 2.0 ** -52 * 2.0 ** (e // 2) * 2.0 ** (e - e // 2) == v
    assert df.limit(0).unionAll(spark.sql("SELECT CAST(NULL AS DOUBLE)")).select(fx.hash_text("v", df.schema["v"].dataType)).first()[0] is None


def test_fingerprint(spark):
    a = spark.createDataFrame([(1, "x", 1.5), (2, None, 2.5), (3, "z", None)], "k int, s string, d double")
    shuffled = a.orderBy(F.desc("k")).repartition(3)
    dup = a.unionByName(a.limit(1))
    changed = a.withColumn("d", F.when(F.col("k") == 2, 2.6).otherwise(F.col("d")))
    moved = spark.createDataFrame([(1, "x", 1.5), (2, None, 2.5), (3, None, None)], "k int, s string, d double")
    fp = lambda df: tuple(changes.dataset_fingerprint(df).first())
    assert fp(a) == fp(shuffled)
    assert fp(a) != fp(dup) and fp(a) != fp(changed) and fp(a) != fp(moved)


def test_check_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99)], "k int, location_id int")
    dim = spark.createDataFrame([(10,)], "location_id int")
    assert changes.check_foreign_keys(fact, dim, "location_id").count() == 1
    assert changes.check_unique_key(fact.unionByName(fact.limit(1)), ["k"]).count() == 1


def test_season_fan_out_and_annual_grain(spark):
    dim_time = spark.createDataFrame([(1, 2020, "year"), (2, 2020, "winter")], "time_id int, year bigint, season string")
    d = spark.createDataFrame([(2020, "FR")], "year int, country string")
    assert sk.join_time_by_year(d, dim_time).count() == 2
    assert sk.join_time_by_year(d, dim_time, "annual").count() == 1


def test_build_star_keys_hold(spark):
    from airshed.plans import catalog_star as cs
    star = cs.star(spark, "/root/testdata/sf0.001")
    for name, (_, keys) in sk.STAR_SCHEMAS.items():
        assert changes.check_unique_key(star[name], keys).count() == 0, name
    for fact, fks in sk.FOREIGN_KEYS.items():
        for col, dim in fks:
            assert changes.check_foreign_keys(star[fact], star[dim], col).count() == 0, (fact, col)


def test_table_store_versions_and_gate(spark, tmp_path):
    from airshed.plans import pipeline as pl
    from airshed.sources.tables import TableStore
    store = TableStore(spark, str(tmp_path / "wh"))
    df = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], "country string, year int, co2 double")
    assert pl.run_staging(store, "staging_x", df, ["country", "year"]) == "loaded"
    assert pl.run_staging(store, "staging_x", df, ["country", "year"]) == "unchanged"
    df2 = spark.createDataFrame([("b", 2, 5.0), ("c", 3, 3.0)], "country string, year int, co2 double")
    assert pl.run_staging(store, "staging_x", df2, ["country", "year"]) == "loaded"
    got = sorted((r["country"], r["co2"]) for r in store.read("staging_x").collect())
    assert got == [("a", 1.0), ("b", 5.0), ("c", 3.0)]
    assert store.version("staging_x") == 2


def test_duplicate_fact_keys_are_refused_before_publish(spark, tmp_path):
    from airshed.operators import changes
    from airshed.sources.tables import TableStore
    store = TableStore(spark, str(tmp_path / "wh"))
    dup = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0)], "time_id int, location_id int, pm10 double")
    check = {"fact_x": lambda df: changes.require_unique(df, ["time_id", "location_id"], "fact_x")}
    with pytest.raises(changes.DuplicateKeyError):
        store.commit({"fact_x": dup}, validate=check)
    assert not store.exists("fact_x")  # nothing published
    ok = dup.limit(1)
    store.commit({"fact_x": ok}, validate=check)
    assert store.read("fact_x").count() == 1


def test_pipeline_from_csv_folders(spark, tmp_path):
    """The user's own files in; a second run on the same files writes no table."""
    from airshed.plans import pipeline as pl
    from airshed.sources import driver_landing as dl
    from airshed.sources.tables import TableStore
    raw = {"d1": dl.raw_air_quality, "d2": dl.raw_apportionment_book, "d3": dl.raw_emissions}
    paths, schemas = {}, {}
    for d, fn in raw.items():
        df = fn(spark, "/root/testdata/sf0.001").drop("_ord")
        paths[d], schemas[d] = str(tmp_path / d), df.schema
        df.write.option("header", True).csv(paths[d])
    store = TableStore(spark, str(tmp_path / "wh"))
    first = pl.run_pipeline(spark, pl.file_inputs(spark, paths, schemas), store)
    versions = {n: store.version(n) for n in first}
    assert set(first.values()) == {"loaded"} and all(store.read(n).count() for n in first)
    second = pl.run_pipeline(spark, pl.file_inputs(spark, paths, schemas), store)
    assert set(second.values()) == {"unchanged"} and {n: store.version(n) for n in first} == versions
    country = store.read("staging_d3").first()["country"]
    pl.delete_from_table(store, "staging_d3", "country", f" {country.upper()} ")
    assert store.read("staging_d3").where(F.col("country") == country).count() == 0
    pl.delete_from_table(store, "staging_d3", "country", "nowhere")
    assert store.version("staging_d3") == versions["staging_d3"] + 1
    store.commit({"plain": spark.range(2).toDF("x")})
    pl.ensure_audit_column(store, "plain")
    pl.ensure_audit_column(store, "plain")
    assert store.read("plain").columns == ["x", "updated_at"] and store.version("plain") == 2


def test_stagings_are_computed_side_by_side_and_loaded_in_order(spark, tmp_path, monkeypatch):
    """All three are under way at once; an error of d2 leaves d1 loaded and nothing of d3 written."""
    from threading import Barrier

    from airshed.plans import pipeline as pl
    from airshed.session import path_exists
    from airshed.sources.tables import TableStore
    met = Barrier(3, timeout=60)

    def stage(df):
        met.wait()
        return df

    def fails(df):
        met.wait()
        raise ValueError("d2")
    monkeypatch.setattr(pl, "load_warehouse", lambda spark, store: {})
    inputs = {d: spark.createDataFrame([(1, d)], "k int, v string") for d in ("d1", "d2", "d3")}
    monkeypatch.setattr(pl, "STAGE", {d: (stage, ["k"]) for d in inputs})
    store = TableStore(spark, str(tmp_path / "a"))
    status = pl.run_pipeline(spark, inputs, store)
    assert [status[f"staging_{d}"] for d in inputs] == ["loaded"] * 3 and [store.read(f"staging_{d}").first()["v"] for d in inputs] == list(inputs)
    monkeypatch.setattr(pl, "STAGE", {d: (fails if d == "d2" else stage, ["k"]) for d in inputs})
    store = TableStore(spark, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="d2"):
        pl.run_pipeline(spark, inputs, store)
    assert store.exists("staging_d1") and not store.exists("staging_d2") and not store.exists("staging_d3")
    assert not path_exists(spark, f"{store.root}/staging_csv/staging_d3")


def test_two_writers_cannot_publish_one_number(spark, tmp_path, monkeypatch):
    from airshed.sources.tables import TableStore
    a, b = (TableStore(spark, str(tmp_path / "wh")) for _ in range(2))
    a.commit({"t": spark.range(1)})
    monkeypatch.setattr(b, "_latest", lambda: 0)  # it looked before the other one published
    with pytest.raises(Exception, match="(?i)exists"):
        b.commit({"t": spark.range(5)})
    assert a.read("t").count() == 1
