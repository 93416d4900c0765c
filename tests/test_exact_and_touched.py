"""Order-free sums, two-level digests, touched-part upserts, split groups."""

import math
import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from airshed import functions as fx
from airshed.operators import changes, impute
from airshed.sources.tables import BUCKET, TableStore


def test_sums_have_the_same_bits_in_any_partitioning(spark):
    rng = random.Random(1)
    values = [rng.choice([1, -1]) * rng.lognormvariate(3, 4) for _ in range(5000)]
    rows = spark.createDataFrame([(i % 50, v) for i, v in enumerate(values)], "k int, v double")
    prints = set()
    for n in (1, 3, 7):
        means = rows.repartition(n).groupBy("k").agg(fx.exact_mean("v").alias("m"), fx.exact_sum("v").alias("s"))
        prints.add(tuple(changes.dataset_fingerprint(means).first()))
    assert len(prints) == 1
    for k, s in rows.groupBy("k").agg(fx.exact_sum("v")).collect():
        true = sum(Fraction(v) for v in values[k::50])
        assert abs(Fraction(s) - true) <= Fraction(100, 2 ** 78) + abs(true) / 2 ** 52  # 100 cuts under 2**-78, one rounding


def test_sums_of_awkward_values(spark):
    total = lambda values: spark.createDataFrame([(v,) for v in values], "v double").agg(fx.exact_sum("v"), fx.exact_mean("v")).first()
    assert tuple(total([])) == tuple(total([None, None])) == (None, None)
    assert tuple(total([1e15, 0.5, -1e15, None])) == (0.5, 0.5 / 3)
    assert total([0.1] * 10)[0] == 1.0 and total([-3.5, -2.25])[0] == -5.75
    assert total([1e300, 1.0])[0] == 1e300 and math.isinf(total([float("inf"), 1.0])[0]) and math.isnan(total([float("nan"), 1.0])[0])


def test_filled_means_do_not_depend_on_the_plan(spark):
    rng = random.Random(2)
    rows = [(f"c{rng.randrange(9)}", f"n{rng.randrange(3)}", None if rng.random() < 0.4 else rng.random() * 1000) for _ in range(3000)]
    df = spark.createDataFrame(rows, "city string, country string, v double")
    levels = [["city"], ["country"]]
    got = {tuple(changes.dataset_fingerprint(impute.impute_chain(df.repartition(n), ["v"], levels, method)).first()) for n, method in ((3, "cells"), (7, "cells"), (5, "window"))}
    assert len(got) == 1


def test_digests_tell_values_and_columns_apart(spark):
    fp = lambda rows, schema="a string, b string": tuple(changes.dataset_fingerprint(spark.createDataFrame(rows, schema)).first())
    seen = [fp(r) for r in ([("a|b", "c")], [("a", "b|c")], [(None, "c")], [("\\N", "c")], [("", "c")], [("-;", "c")], [("1:a;", "")], [("a", "")])]
    assert len(set(seen)) == len(seen)
    assert fp([("a", "b"), ("c", "d")]) == fp([("c", "d"), ("a", "b")]) != fp([("a", "b"), ("c", "d"), ("c", "d")])
    assert fp([])[0] == 0


def test_a_changed_row_names_its_bucket(spark):
    df = spark.range(2000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 1.5).alias("v"))
    before = changes.bucket_digests(df, ["k"])
    edited = df.withColumn("v", F.when(F.col("k") == 77, -1.0).otherwise(F.col("v"))).repartition(9)
    own = df.where("k = 77").select(fx.key_bucket(df, ["k"], changes.BUCKETS)).first()[0]
    assert changes.changed_buckets(before, changes.bucket_digests(edited, ["k"])) == [own]
    assert changes.changed_buckets(before, changes.bucket_digests(df.repartition(3), ["k"])) == []
    assert changes.changed_buckets(before, changes.bucket_digests(df.where("k <> 77"), ["k"])) == [own]
    assert len(changes.changed_buckets(before, changes.bucket_digests(df.where("false"), ["k"]))) == before.count()


def files_of(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_upsert_reads_and_writes_the_touched_parts_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    rows = lambda a, b, tag: spark.range(a, b).select(F.col("id").cast("int").alias("k"), F.lit(tag).alias("v"))
    assert store.upsert("t", rows(0, 5000, "old"), ["k"]) == 1
    path = store._manifest()["t"]["path"]
    before = files_of(path)
    assert len(before) == changes.BUCKETS
    batch = rows(40, 41, "new").union(rows(9000, 9001, "new"))
    touched = {r[0] for r in batch.select(fx.key_bucket(batch, ["k"], changes.BUCKETS)).collect()}
    assert store.upsert("t", batch, ["k"]) == 2 and store._manifest()["t"]["path"] == path
    after = files_of(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in after.keys() - kept} == touched and len(kept) == changes.BUCKETS - len(touched)
    got = {r["k"]: r["v"] for r in store.read("t").collect()}
    assert len(got) == 5001 and got[40] == got[9000] == "new" and got[41] == "old" and store.read("t").columns == ["k", "v"]
    assert store.upsert("t", batch, ["k"]) == 3 and store.read("t").count() == 5001  # the same batch again changes nothing
    with pytest.raises(changes.DuplicateKeyError):
        store.upsert("t", batch.union(batch), ["k"])
    with pytest.raises(changes.DuplicateKeyError):
        store.upsert("other", batch.union(batch), ["k"])
    assert store.upsert("t", batch.where("false"), ["k"]) == 4 and store.read("t").count() == 5001


def test_upsert_of_null_keys_and_of_plain_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    df = spark.createDataFrame([("a", 1, 1.0), (None, 1, 2.0)], "c string, y int, v double")
    store.commit({"t": df})  # written whole, without parts
    store.upsert("t", df, ["c", "y"])
    assert sorted(map(str, store.read("t").collect())) == sorted(map(str, df.union(df.where("c is null")).collect()))  # a null key matches nothing
    assert store.version("t") == 2


def test_group_transform_splits_a_hot_group(spark):
    rng = random.Random(3)
    rows = [(None if i % 50 == 7 else "hot" if i % 2 else f"g{i % 20}", None if i % 11 == 0 else rng.random()) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    outs = {"m": ("mean", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "n": ("count", "v")}
    got = impute.group_transform(df, ["g"], outs).collect()
    want = {}
    for g, v in rows:
        want.setdefault(g, []).extend([] if v is None else [v])
    assert len(got) == len(rows)
    for r in got:
        vs = want[r["g"]]
        assert (r["lo"], r["hi"], r["n"]) == (min(vs), max(vs), len(vs)) and r["m"] == pytest.approx(sum(vs) / len(vs), abs=1e-12)
    salted = impute.group_transform(df.where("g = 'hot'"), ["g"], outs)
    assert "__salt" in salted._jdf.queryExecution().toString()


def test_limbs_hold_a_double_exactly_and_take_no_remainder(spark):
    rng = random.Random(2)
    values = [0.0, -0.5, 1 / 3, -2.0 ** 53 - 2, 2.0 ** 60 - 256, 1e-300] + [rng.choice([1, -1]) * rng.random() * 2.0 ** rng.randint(-24, 59) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values + [2.0 ** 60, math.inf, math.nan, None]], "x double")
    parts = fx.limbs("x")
    assert not any("%" in str(p) for p in parts)  # a remainder of doubles took most of the time of d2's means
    for r in df.select("x", F.array(*parts).alias("p")).collect():
        if r.x is None or not abs(r.x) < 2.0 ** 60:
            assert r.p == [None] * 5
        else:
            total = sum(Fraction(n) * Fraction(2) ** k for n, k in zip(r.p, (26, 0, -26, -52, -78)))
            unit = Fraction(1, 2 ** 78)
            assert total == int(Fraction(r.x) / unit) * unit and all(abs(n) < 2 ** 34 + 1 for n in r.p)
