"""Clustering: silhouette fixture and brute force, Lloyd rules, PCA."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from promo_engine.functions import vectors as V
from promo_engine.operators import cluster as CU


def _pts(spark, arr, clusters=None):
    rows = [(i, [float(v) for v in p], None if clusters is None else int(clusters[i]))
            for i, p in enumerate(arr)]
    return spark.createDataFrame(rows, "id long, p array<double>, cluster int")


def _brute_silhouette(x, c):
    x = np.asarray(x, float)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)  # squared Euclidean (test-only brute force)
    out = []
    for i in range(len(x)):
        own = c == c[i]
        if own.sum() <= 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, c == k].mean() for k in set(c) if k != c[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_four_point_fixture(spark):
    df = _pts(spark, [(0, 0), (0, 1), (10, 0), (10, 1)], [0, 0, 1, 1])
    s = [r.silhouette for r in CU.silhouette_points(df).collect()]
    assert s == pytest.approx([(100.5 - 1) / 100.5] * 4)


def test_silhouette_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (30, 3)), [[9, 9, 9]]])
    c = np.array([0] * 40 + [1] * 30 + [2])  # cluster 2 is a singleton
    got = {r.id: r.silhouette for r in CU.silhouette_points(_pts(spark, x, c)).collect()}
    exp = _brute_silhouette(x, c)
    assert [got[i] for i in range(len(x))] == pytest.approx(list(exp), abs=1e-9)
    assert all(-1 <= v <= 1 for v in got.values())


def test_nearest_ties_lowest_index(spark):
    df = _pts(spark, [(0.0, 0.0)])
    r = df.select(V.nearest("p", [[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0]]).alias("c")).first()
    assert r.c == 0


def test_lloyd_inertia_non_increasing(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (50, 2)), rng.normal(6, 1, (50, 2)), rng.normal((0, 6), 1, (50, 2))])
    pts = _pts(spark, x).drop("cluster")
    cur = CU.initial_centres(pts, 3, seed=1)
    inertias = []
    for _ in range(6):
        a = CU.assign(pts, cur)
        inertias.append(sum(min(((p - np.array(c)) ** 2).sum() for c in cur) for p in x))
        cur, shift, _ = CU.lloyd_update(a, cur)
    assert all(b <= a + 1e-9 for a, b in zip(inertias, inertias[1:]))
    res = CU.lloyd_kmeans(pts, 3, seed=1)
    assert res.passes <= CU.MAX_PASSES
    assert res.assigned.select("cluster").distinct().count() == 3


def test_lloyd_step_empty_cluster_keeps_centre(spark):
    pts = _pts(spark, [(0, 0), (1, 0)]).drop("cluster")
    t = {r.cluster: r for r in CU.lloyd_step_table(pts, [[0.0, 0.0], [100.0, 100.0]]).collect()}
    assert t[1].n_points == 0 and t[1].centre == [100.0, 100.0] and t[1].shift == 0.0
    assert t[0].n_points == 2 and t[0].centre == [0.5, 0.0] and t[0].shift == pytest.approx(0.5)


def test_pca_centred(spark, sf):
    from promo_engine.sources.tables import read_table
    pts = CU.embedding_points(read_table(spark, sf, "embeddings"))
    p = CU.pca_2d(pts).select("x", "y").toPandas()
    assert abs(p.x.mean()) < 1e-9 and abs(p.y.mean()) < 1e-9
    assert p.x.var() >= p.y.var()


def test_distances(spark):
    df = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "a array<double>, b array<double>")
    r = df.select(V.euclidean("a", "b").alias("e"), V.manhattan("a", "b").alias("m")).first()
    assert (r.e, r.m) == (5.0, 7.0)


def test_choose_k_first_best(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(0, .2, (30, 2)), rng.normal(5, .2, (30, 2))])
    out = CU.choose_k(_pts(spark, x).drop("cluster"), ks=range(2, 5), seed=1).collect()
    chosen = [r.k for r in out if r.chosen == 1]
    assert chosen == [2]
    assert not math.isnan(out[0].silhouette)


def test_literal_vector_is_bit_exact(spark):
    vals = [0.1, -0.5, 1e-05, 1.2345678901234567e300, -3.0e-320, 2.0 / 3.0, 0.0, 123456789.123]
    got = spark.range(1).select(V.literal_vector(vals).alias("v")).first().v
    assert [x.hex() for x in got] == [float(x).hex() for x in vals]


def test_all_k_at_once_equal_single_fits(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, (40, 2)), rng.normal(6, 1, (40, 2)), rng.normal((0, 6), 1, (40, 2))])
    pts = _pts(spark, x).drop("cluster")
    many = CU.lloyd_many(pts, range(2, 6), seed=3)
    for k, fit in many.items():
        one = CU.lloyd_kmeans(pts, k, seed=3)
        assert (one.centres, one.passes, one.shift, one.used) == (fit.centres, fit.passes, fit.shift, fit.used)
    scores = CU.mean_silhouettes(pts, {k: f.used for k, f in many.items()})
    for k, fit in many.items():
        assert scores[k] == pytest.approx(CU.mean_silhouette(fit.assigned), abs=1e-12)


def test_all_k_are_few_jobs(spark):
    rng = np.random.default_rng(2)
    pts = _pts(spark, rng.normal(size=(200, 2))).drop("cluster")
    group = "choose-k-jobs"
    spark.sparkContext.setJobGroup(group, "all k")
    out = CU.choose_k(pts, ks=range(2, 11), seed=5)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # two jobs (a shuffle map stage and its result) for each pass under AQE, a few around them
    assert out.count() == 9 and jobs <= 2 * CU.MAX_PASSES + 14


def test_grid_mean_has_no_order(spark):
    rng = np.random.default_rng(4)
    vals = [float(v) for v in rng.normal(size=999) * 1e3]
    a = spark.createDataFrame([(v,) for v in vals], "x double")
    b = spark.createDataFrame([(v,) for v in sorted(vals)], "x double").repartition(7)
    got = [d.agg(CU.grid_mean(F.col("x"))).first()[0] for d in (a, b)]
    assert got[0] == got[1] == pytest.approx(math.fsum(vals) / len(vals), abs=1e-12)
    big = spark.createDataFrame([(1e300,), (3e300,)], "x double")
    assert big.agg(CU.grid_mean(F.col("x"))).first()[0] == 2e300


def test_pca_far_from_the_origin(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 5)) * [5, 3, 1, .5, .1]
    near = np.linalg.svd(x - x.mean(0), full_matrices=False)
    got = CU.pca_2d(_pts(spark, x + 1e8).drop("cluster")).orderBy("id").select("x", "y").toPandas().to_numpy()
    want = (x - x.mean(0)) @ near[2][:2].T
    want *= np.sign(near[2][:2][np.arange(2), np.abs(near[2][:2]).argmax(1)])
    assert np.abs(got - want).max() < 1e-5          # of points known to 1e-8 at 1e8
    few = CU.pca_2d(_pts(spark, [(1.0, 2.0, 3.0), (2.0, 2.0, 3.0)]).drop("cluster")).orderBy("id").collect()
    assert [(r.x, r.y) for r in few] == [(pytest.approx(-0.5), 0.0), (pytest.approx(0.5), 0.0)]
    assert CU.pca_2d(_pts(spark, [(1.0, 2.0)]).drop("cluster").limit(0)).count() == 0


@pytest.mark.parametrize("block", [2048, 7])
def test_euclidean_silhouette_is_brute_force(spark, block):
    from promo_engine.operators.silhouette import euclidean_silhouette
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (60, 64)), rng.normal(.4, 1, (50, 64)), rng.normal(4, 1, (40, 64)), [[9.0] * 64]])
    c = np.array([0] * 60 + [1] * 50 + [2] * 40 + [3])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    want = []
    for i in range(len(x)):
        own = c == c[i]
        a = d[i, own].sum() / max(1, own.sum() - 1)
        b = min(d[i, c == k].mean() for k in set(c) if k != c[i])
        want.append(0.0 if own.sum() == 1 else (b - a) / max(a, b))
    df = _pts(spark, x, c).withColumn("target", F.lit("clash"))
    got = {r.id: r.silhouette for r in euclidean_silhouette(df, block).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(want, abs=1e-9)


def test_euclidean_silhouette_skips_far_clusters(spark):
    from promo_engine.operators import silhouette as SI
    x = np.concatenate([np.random.default_rng(i).normal(100 * i, 1, (30, 2)) for i in range(6)])
    c = np.repeat(np.arange(6), 30)
    pts = _pts(spark, x, c).select(F.col("id").alias("row"), F.col("cluster").cast("bigint").alias("c"), "p")
    asked = SI._asked(pts, SI._clusters(pts))
    # its own cluster and one or two others, of six
    assert asked.count() <= 180 * 3 and asked.groupBy("row").count().agg(F.min("count")).first()[0] >= 2


def test_euclidean_silhouette_edges(spark):
    from promo_engine.operators.silhouette import euclidean_silhouette
    rows = [(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.0, 0.0], 2), (3, [0.0, 0.0], 2), (4, None, 1), (5, [1.0, None], 2),
            (6, [float("nan"), 1.0], 1), (7, [1.0, 1.0], None)]
    df = spark.createDataFrame(rows, "id long, p array<double>, cluster int")
    got = {r.id: r.silhouette for r in euclidean_silhouette(df).collect()}
    assert got == {0: 0.0, 1: 0.0, 2: 0.0, 3: 0.0, 4: None, 5: None, 6: None, 7: None}
    one = euclidean_silhouette(df.where("cluster = 1")).collect()
    assert {r.silhouette for r in one if r.id < 2} == {0.0}
    assert euclidean_silhouette(df.limit(0)).count() == 0


def test_distance_sums_are_fast_and_exact():
    """Matrix products take a fraction of the time of differences; copies, near copies far away and huge values keep their digits."""
    import time

    from promo_engine.operators import silhouette as SI
    rng = np.random.default_rng(5)

    def plain(x, y):
        return np.array([np.sqrt(sum((a[d] - y[:, d]) ** 2 for d in range(x.shape[1]))).sum() for a in x])
    x = rng.normal(size=(1500, 64))
    near = 1e6 + np.repeat(x[:20], 3, axis=0) * 1e-3 + rng.normal(size=(60, 64)) * 1e-9
    for points in (x[:200], near, np.vstack([near, x[:50]]), x[:30] * 1e160, np.repeat(x[:4], 5, axis=0)):
        with np.errstate(over="ignore"):
            assert np.allclose(SI.distance_sums(points, points), plain(points, points), rtol=1e-9, atol=0)
    square = np.zeros((len(x), len(x)))
    start = time.process_time()
    for d in range(64):
        square += (x[:, d, None] - x[None, :, d]) ** 2
    slow = time.process_time() - start
    start = time.process_time()
    SI.distance_sums(x, x)
    assert time.process_time() - start < slow / 2
