"""Models beside their SQL oracles: clustering and ARIMA, FIXTURES.md §3 / SURVEY §5 kind 4."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airshed.operators import cluster as cl
from airshed.operators import forecast as fc


def blobs(spark, n=60, seed=1):
    rng = np.random.default_rng(seed)
    centers = [(0.0, 0.0), (10.0, 10.0), (20.0, 0.0)]
    data = []
    for c, (x, y) in enumerate(centers):
        for i in range(n):
            data.append((c * n + i, c, float(x + rng.normal()), float(y + rng.normal())))
    return spark.createDataFrame(data, "id int, truth int, a double, b double")


def test_standardise_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    out = cl.standardise(df, ["x", "c"]).collect()
    assert sorted(r["x"] for r in out) == [-1.0, 1.0]
    assert all(r["c"] == 0.0 for r in out)


def brute_ward(points, k):
    clusters = [[i] for i in range(len(points))]
    while len(clusters) > k:
        best = None
        for i in range(len(clusters)):
            for j in range(i + 1, len(clusters)):
                a, b = points[clusters[i]], points[clusters[j]]
                na, nb = len(a), len(b)
                cost = na * nb / (na + nb) * ((a.mean(0) - b.mean(0)) ** 2).sum()
                if best is None or cost < best[0]:
                    best = (cost, i, j)
        _, i, j = best
        clusters[i] += clusters.pop(j)
    labels = np.empty(len(points), dtype=int)
    for lab, members in enumerate(clusters):
        labels[members] = lab
    return labels


def same_partition(a, b):
    return len({(x, y) for x, y in zip(a, b)}) == len(set(a)) == len(set(b))


def test_ward_merge_equals_brute_force():
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(40, 3))
    got = cl.ward_merge(pts, np.ones(len(pts)), 4)
    assert same_partition(got, brute_ward(pts, 4))


def test_ward_and_kmeans_recover_blobs(spark):
    df = blobs(spark).withColumn("x", cl.features_array(["a", "b"], "x"))
    ward = cl.ward_clusters(df, "x", 3).select("truth", "cluster").collect()
    assert same_partition([r[0] for r in ward], [r[1] for r in ward])
    km = cl.kmeans(df, "x", 3).select("truth", "cluster").collect()
    assert same_partition([r[0] for r in km], [r[1] for r in km])


def gamma_points(spark, n=2000):
    rng = np.random.default_rng(8)
    data = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.gamma(2.0, 1.0, (n, 2)))]
    return spark.createDataFrame(data, "id int, a double, b double").withColumn("x", cl.features_array(["a", "b"], "x"))


def test_kmeans_does_not_depend_on_partitions(spark):
    df = gamma_points(spark)
    got = [{r.id: r.cluster for r in cl.kmeans(df.repartition(n), "x", 5).collect()} for n in (1, 4, 9)]
    assert got[0] == got[1] == got[2] and len(set(got[0].values())) == 5


def test_ward_changes_little_by_little_with_the_cells(spark):
    """Overlapping data: no jump where rows begin to share cells."""
    df = gamma_points(spark, 900)
    exact = {r.id: r.cluster for r in cl.ward_clusters(df, "x", 3, max_micro=1024).collect()}
    shared = {r.id: r.cluster for r in cl.ward_clusters(df, "x", 3, max_micro=880).collect()}
    pts = np.array([[r.a, r.b] for r in sorted(df.collect(), key=lambda r: r.id)])
    best = cl.ward_merge(pts, np.ones(len(pts)), 3)
    assert same_partition([exact[i] for i in range(900)], best)
    pairs = {}
    for i in exact:
        pairs[exact[i], shared[i]] = pairs.get((exact[i], shared[i]), 0) + 1
    agree = sum(max(v for (a, _), v in pairs.items() if a == k) for k in set(exact.values()))
    assert agree >= 0.9 * len(exact)


def test_ward_two_phase_above_micro_limit(spark):
    df = blobs(spark, n=100).withColumn("x", cl.features_array(["a", "b"], "x"))
    out = cl.ward_clusters(df, "x", 3, max_micro=30).select("truth", "cluster").collect()
    assert same_partition([r[0] for r in out], [r[1] for r in out])


def test_cluster_names_follow_feature_order(spark):
    df = blobs(spark).withColumn("x", cl.features_array(["a", "b"], "x"))
    named = cl.name_clusters(df.withColumnRenamed("truth", "cluster"), "cluster", "a", cl.WARD_NAMES)
    by_truth = dict(named.groupBy("cluster").agg(F.first("cluster_name")).collect())
    assert by_truth == {0: "Faible Pollution", 1: "Modérée", 2: "Élevée"}
    with pytest.raises(ValueError):
        cl.name_clusters(df.withColumn("cluster", F.col("truth") % 2), "cluster", "a", cl.WARD_NAMES)


def along(spark, groups, n=40):
    """Groups of points along the line (c, -c)."""
    rng = np.random.default_rng(4)
    rows = [(g * n + i, g, float(c + e), float(-c + f)) for g, c in enumerate(groups) for i, (e, f) in enumerate(rng.normal(0, 0.2, (n, 2)))]
    return spark.createDataFrame(rows, "id int, truth int, a double, b double").withColumn("x", cl.features_array(["a", "b"], "x"))


def test_kmeans_on_the_other_diagonal(spark):
    for groups in ([-5, 5], [-6, 0, 6], [-9, -3, 3, 9]):
        got = cl.kmeans(along(spark, groups), "x", len(groups)).select("truth", "cluster").collect()
        assert same_partition([r[0] for r in got], [r[1] for r in got])


def test_kmeans_fills_empty_clusters(spark):
    rows = [(float(v), 0.0) for v in (0, 0, 0, 1, 2, 3, 50)]
    df = spark.createDataFrame(rows, "a double, b double").withColumn("x", cl.features_array(["a", "b"], "x"))
    for k in range(1, 6):
        assert cl.kmeans(df, "x", k).select("cluster").distinct().count() == k
    assert cl.kmeans(df, "x", 9).select("cluster").distinct().count() == 5  # five distinct points
    assert cl.kmeans(df.where("false"), "x", 3).count() == 0
    points = df.select("x")
    lost = np.array([[0.0, 0.0], [1000.0, 0.0], [2000.0, 0.0]])  # two centres that no point is near
    moved = cl.lloyd(points, {3: lost}, iterations=1)[3]
    assert [50.0, 0.0] in moved.tolist() and moved[2].tolist() == [2000.0, 0.0]  # one cluster has one farthest point to give


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        mean = {c: d[i, labels == c].sum() / max(1, (labels == c).sum() - (c == own)) for c in set(labels)}
        rest = [v for c, v in mean.items() if c != own]
        out.append(0.0 if (labels == own).sum() == 1 or not rest else (min(rest) - mean[own]) / max(min(rest), mean[own]))
    return np.array(out)


def test_euclidean_silhouette_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cl, "BLOCK", 700)
    rng = np.random.default_rng(9)
    x, labels, other = rng.gamma(2, 1, (2000, 3)), rng.integers(0, 4, 2000), rng.integers(0, 2, 2000)
    labels[0] = 9  # a singleton
    df = spark.createDataFrame([(i, [float(v) for v in p], int(a), str(b)) for i, (p, a, b) in enumerate(zip(x, labels, other))], "id int, x array<double>, label int, other string")
    got = sorted(cl.euclidean_silhouettes(df.repartition(5), "x", ["label", "other"]).select("id", "silhouette_label", "silhouette_other").collect())
    assert np.allclose([r[1] for r in got], brute_silhouette(x, labels)) and np.allclose([r[2] for r in got], brute_silhouette(x, other))
    assert cl.silhouette(df, "x", "label").first()[0] == pytest.approx(brute_silhouette(x, labels).mean())


def test_ranks_of_many_clusters(spark):
    df = spark.range(100_000).select(F.col("id").alias("c"), ((F.col("id") * 7919) % 100_000).cast("double").alias("v"))
    got = cl.name_clusters(df, "c", "v").agg(F.countDistinct("cluster_name"), F.count(F.when(F.col("cluster_name") != F.concat(F.lit("Cluster "), (F.col("v") + 1).cast("int")), 1))).first()
    assert tuple(got) == (100_000, 0)


def test_silhouette_matches_spark_evaluator_and_bounds(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    df = blobs(spark).withColumn("x", cl.features_array(["a", "b"], "x"))
    ours = cl.silhouette(df, "x", "truth", squared=True).first()["silhouette"]
    ev = ClusteringEvaluator(featuresCol="v", predictionCol="truth", distanceMeasure="squaredEuclidean")
    theirs = ev.evaluate(df.withColumn("v", array_to_vector("x")).withColumn("truth", F.col("truth").cast("double")))
    assert ours == pytest.approx(theirs, abs=1e-9)
    pts = cl.silhouette_points(df, "x", "truth")
    assert pts.filter((F.col("silhouette") < -1) | (F.col("silhouette") > 1)).count() == 0


def test_choose_k_prefers_planted_k(spark):
    df = blobs(spark).withColumn("x", cl.features_array(["a", "b"], "x"))
    table, k = cl.choose_k_silhouette(df, "x", max_k=5)
    assert k == 3 and table.count() == 4


def simulate(phi, theta, n, seed=0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 1)
    d = np.zeros(n)
    for t in range(1, n):
        d[t] = phi * d[t - 1] + e[t] + theta * e[t - 1]
    return 100 + np.cumsum(d)


def test_arima_recovers_parameters():
    y = simulate(0.6, 0.3, 600)
    phi, theta, _, _ = fc.fit_arima111(y)
    assert phi == pytest.approx(0.6, abs=0.12) and theta == pytest.approx(0.3, abs=0.15)


def kalman_deviance(d, phi, theta):
    """-2 log likelihood by a plain Kalman filter of the differences, state (y', theta e), the error variance at its best."""
    move, noise = np.array([[phi, 1.0], [0.0, 0.0]]), np.array([[1.0, theta], [theta, theta * theta]])
    state = np.zeros(2)
    spread = np.linalg.solve(np.eye(4) - np.kron(move, move), noise.ravel()).reshape(2, 2)
    squares = logs = 0.0
    for x in d:
        v, f = x - state[0], spread[0, 0]
        gain = spread[:, 0] / f
        squares, logs = squares + v * v / f, logs + np.log(f)
        state = move @ (state + gain * v)
        spread = move @ (spread - np.outer(gain, spread[0])) @ move.T + noise
    return len(d) * np.log(squares) + logs


@pytest.mark.parametrize(("phi", "theta", "n"), [(0.6, 0.3, 80), (-0.5, 0.4, 60), (0.2, -0.6, 120), (0.8, -0.2, 40)])
def test_arima_is_the_likelihood_fit_of_a_kalman_filter(phi, theta, n):
    y = simulate(phi, theta, n)
    d = np.diff(y)
    rng = np.random.default_rng(2)
    ph, th = rng.uniform(-0.95, 0.95, (2, 300))
    plain = np.array([kalman_deviance(d, a, b) for a, b in zip(ph, th)])
    assert np.allclose(fc.deviance(d, ph, th)[0], plain, atol=1e-8)
    a, b, last, _ = fc.fit_arima111(y)
    best = kalman_deviance(d, a, b)
    assert best <= plain.min() and last == d[-1]
    # The pair is where the filter's likelihood is flat: Newton's step from it is short.
    h = 1e-3
    at = lambda i, j: kalman_deviance(d, a + i * h, b + j * h)
    slope = np.array([at(1, 0) - at(-1, 0), at(0, 1) - at(0, -1)]) / (2 * h)
    cross = (at(1, 1) - at(1, -1) - at(-1, 1) + at(-1, -1)) / (4 * h * h)
    curve = np.array([[at(1, 0) - 2 * best + at(-1, 0), cross * h * h], [cross * h * h, at(0, 1) - 2 * best + at(0, -1)]]) / (h * h)
    assert np.abs(np.linalg.solve(curve, slope)).max() < 1e-4


def test_arima_of_flat_and_straight_series():
    assert np.allclose(fc.forecast_arima111(np.full(6, 3.0), 3), 3.0)
    straight = fc.forecast_arima111(np.arange(8.0), 2)
    assert 7.5 < straight[0] < 8.5 and np.isfinite(straight).all()


def test_short_series_rules(spark):
    data = [("pm10", 1, 2000 + i, float(i)) for i in range(4)] + [("pm10", 2, 2000 + i, float(i * i)) for i in range(5)]
    s = spark.createDataFrame(data, "pollutant string, location_id int, year int, value double")
    bt = {r["location_id"] for r in fc.arima_backtest(s).collect()}
    assert bt == {2}
    fcst = fc.arima_forecast(s, end_year=2006).collect()
    assert {r["location_id"] for r in fcst} == {1, 2} and {r["year"] for r in fcst} == {2005, 2006}
    assert fc.arima_forecast(s, end_year=2003).count() == 0


def test_one_and_two_points_give_a_flat_forecast(spark):
    s = spark.createDataFrame([("no2", 1, 2000, 7.0), ("no2", 2, 1999, 3.0), ("no2", 2, 2000, 5.0)], "pollutant string, location_id int, year int, value double")
    got = sorted((r.location_id, r.year, r.pred) for r in fc.arima_forecast(s, end_year=2002).collect())
    assert got == [(1, 2001, 7.0), (1, 2002, 7.0), (2, 2001, 5.0), (2, 2002, 5.0)]


def test_forecast_files(spark, tmp_path):
    from airshed.plans import analytics as an
    s = spark.createDataFrame([("pm10", 1, 2000 + i, float(i % 3)) for i in range(6)], "pollutant string, location_id int, year int, value double")
    _, summary, forecasts = an.forecast_pollutants(s, 2008, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "forecasts"))
    assert back.count() == forecasts.count() == 3 and summary.count() == 1


def test_series_fitted_together_equal_each_alone():
    rng = np.random.default_rng(8)
    ys = [np.round(rng.normal(20, 5, n), 6) for n in rng.integers(0, 40, fc.TOGETHER + 20)] + [np.array([1.0, np.nan, 2.0, 3.0]), np.full(7, 4.0)]
    assert fc.fit_many(ys) == [fc.fit_arima111(y) for y in ys]
    assert fc.fit_many([]) == []


def test_a_batch_of_series_is_searched_at_once(monkeypatch):
    calls, plain = [], fc._deviances
    monkeypatch.setattr(fc, "_deviances", lambda ds, *pairs: calls.append(len(ds)) or plain(ds, *pairs))
    fc.fit_many([np.arange(9.0) ** 2] * fc.TOGETHER)
    assert len(calls) == fc.REFINEMENTS + 2 and set(calls) == {fc.TOGETHER}  # not as many for each series


def test_silhouette_points_are_spread_and_sums_kept_in_one_table(spark, monkeypatch):
    monkeypatch.setattr(cl, "BLOCK", 60)
    kept, plain = {}, cl.materialize
    monkeypatch.setattr(cl, "materialize", lambda df, name: kept.setdefault(name, plain(df, name)))
    df = spark.range(500, numPartitions=1).select("id", F.array(F.col("id").cast("double") % 37, F.col("id").cast("double") % 11).alias("x"), (F.col("id") % 3).alias("label"))
    out = cl.euclidean_silhouettes(df, "x", ["label"])
    assert kept["silhouette-points"].select(F.input_file_name()).distinct().count() >= 8 and "silhouette-sums" not in kept
    rows = sorted(out.select("id", "silhouette_label").collect())
    x = np.array([[i % 37, i % 11] for i in range(500)], dtype=float)
    assert len(rows) == 500 and np.allclose([r[1] for r in rows], brute_silhouette(x, np.arange(500) % 3))


def pair_sums(x, y, labels, sizes):
    batch = pa.RecordBatch.from_arrays([pa.array(list(y)), *[pa.array(np.asarray(v)) for v in labels]], ["x", *[f"l{g}" for g in range(len(labels))]])
    return np.array(list(cl._tile_sums(x, np.arange(len(x)), sizes)(iter([batch])))[0].column("sums").to_pylist())


def test_pair_sums_of_close_far_and_endless_points():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5))
    x[:40] = x[40:80] + 1e-9 * rng.normal(size=(40, 5))  # nearly equal
    x[80:90] = x[90:100]  # equal
    labels, sizes = [rng.integers(0, 3, 300), rng.integers(0, 4, 300)], [3, 4]
    for points in (x, x + 1e6, x * 1e100, np.where(np.arange(300)[:, None] == 7, 1e153, x)):
        d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
        want = np.concatenate([np.stack([d[:, v == c].sum(1) for c in range(k)], axis=1) for v, k in zip(labels, sizes)], axis=1)
        assert np.allclose(pair_sums(points, points, labels, sizes), want, rtol=1e-11, atol=0)
    assert not np.isfinite(pair_sums(x, np.where(np.arange(300)[:, None] == 7, np.inf, x), labels, sizes)).any()


def test_pairs_are_products_and_sums_of_stretches(monkeypatch):
    calls = []
    monkeypatch.setattr(cl, "_differences", lambda *a: calls.append(a))
    x = np.random.default_rng(3).normal(size=(400, 64))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.allclose(pair_sums(x, x, [np.zeros(400, int)], [1])[:, 0], d.sum(1)) and not calls


def test_ward_is_exact_beyond_the_clusters_of_the_driver(spark, monkeypatch, n=500, seed=2):
    monkeypatch.setattr(cl, "BLOCK", 200)
    monkeypatch.setattr(cl, "TILE", 16)
    monkeypatch.setattr(cl, "STRIP", 16)
    x = np.random.default_rng(seed).gamma(2.0, 1.0, (n, 2))
    x[:20] = x[20:40]  # equal rows
    x[-1] = 60.0  # an outlier that merges last
    best = cl.ward_merge(x, np.ones(n), 4)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id int, x array<double>")
    for most in (5000, 40):
        got = {r.id: r.cluster for r in cl.ward_clusters(df, "x", 4, max_micro=most).collect()}
        assert len(got) == n and same_partition([got[i] for i in range(n)], best)


def test_ward_of_a_grid_and_of_few_points(spark):
    grid = spark.range(144).select((F.col("id") % 12).cast("double").alias("a"), F.floor(F.col("id") / 12).cast("double").alias("b")).withColumn("x", cl.features_array(["a", "b"], "x"))
    runs = [sorted(cl.ward_clusters(grid.repartition(n), "x", 3, max_micro=most).select("a", "b", "cluster").collect()) for n, most in ((1, 1024), (3, 30))]
    assert runs[0] == runs[1] and {r.cluster for r in runs[0]} == {0, 1, 2}
    assert {r.cluster for r in cl.ward_clusters(grid.limit(2), "x", 3).collect()} == {0, 1}
    assert [r.cluster for r in cl.ward_clusters(grid.limit(1), "x", 3).collect()] == [0]
    assert cl.ward_clusters(grid.where("false"), "x", 3).count() == 0
