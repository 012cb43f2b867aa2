"""Clustering: PCA to 2-D, k-means (MLlib and an exact Lloyd loop for any
number of k at once), silhouette, choice of k, cluster report.

Scale notes
-----------
* Points stay distributed; only model state (k centres x d dims, or the
  d x d triangular factor of the PCA) reaches the driver.
* A Lloyd pass is one scan and one grouped aggregate for all k that still
  move: each point goes to one centre per k, and partial aggregation reduces
  the sums to (k, cluster) rows before the shuffle.
* Start points and sums don't depend on the engine or the order of the rows:
  starts are the first points by md5, sums are whole numbers of ``1 / GRID``.
* The silhouette is computed from per-cluster sufficient statistics (count,
  coordinate sums, sum of squared norms) -- O(n k), never all pairs.  This
  makes it the silhouette of the *squared* Euclidean distance (the metric
  MLlib's ``ClusteringEvaluator`` uses); ``operators.silhouette`` has the
  plain distance.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promo_engine.functions import vectors as V
from promo_engine.functions.coupon import stable_mean
from promo_engine.session import cut_lineage

THRESHOLD = 0.0001   # fixed value: total centre shift that ends the Lloyd loop
MAX_PASSES = 21      # fixed value: passes allowed by the loop (20 + 1)
K_RANGE = range(2, 11)
GRID = 2.0 ** 40     # coordinates are added up as whole numbers of 1 / GRID
FITS = 2.0 ** 22     # where larger ones occur, a mean is the plain one of doubles


def embedding_points(emb: DataFrame) -> DataFrame:
    """(id, p array<double>) from the ``embeddings`` table."""
    return emb.select(F.col("vec_id").alias("id"), V.as_doubles("embedding").alias("p"), "label")


def mean_point(points: DataFrame) -> list[float] | None:
    """The mean of all points (one number per dimension), or None without points."""
    rows = (points.select(F.posexplode("p").alias("pos", "x")).groupBy("pos").agg(F.avg("x").alias("m"))
            .orderBy("pos").collect())
    return [r["m"] for r in rows] or None


def principal_axes(points: DataFrame, k: int = 2) -> tuple[list[float], list[list[float]]] | None:
    """(mean, axes): the first ``k`` principal axes of the points ``p``.

    The centred points are reduced to a triangular factor by a tall-skinny QR
    decomposition (each partition its own, the factors merged in a tree), so
    no covariance is formed and points far from the origin lose no digits.
    The driver decomposes the d x d factor.  An axis points to the side of its
    largest part (the first, on ties).  Dimensions without variance give zero
    axes beyond the rank of the data.
    """
    mean = mean_point(points)
    if mean is None:
        return None
    centred = points.select(array_to_vector(F.zip_with("p", V.literal_vector(mean), lambda x, m: x - m)).alias("v"))
    r = RowMatrix(MLUtils.convertVectorColumnsFromML(centred, "v")).tallSkinnyQR(False).R.toArray()
    _, size, vt = np.linalg.svd(r, full_matrices=True)
    axes = []
    for i in range(k):
        known = i < len(size) and size[i] > size[0] * 1e-12
        v = vt[i] if known else np.zeros(len(mean))
        axes.append([float(x) for x in (-v if v[np.argmax(np.abs(v))] < 0 else v)])
    return mean, axes


def pca_2d(points: DataFrame, id_col: str = "id", k: int = 2) -> DataFrame:
    """M4: centre the points, project on the first ``k`` principal axes."""
    got = principal_axes(points.select("p"), k)
    if got is None:
        along = [F.lit(None).cast("double")] * k
    else:
        about = F.zip_with("p", V.literal_vector(got[0]), lambda x, m: x - m)
        along = [V.dot(about, V.literal_vector(axis)) for axis in got[1]]
    out = points.select(id_col, F.array(*along).alias("p"))
    return out.select(id_col, "p", *[F.col("p")[i].alias("xy"[i] if k == 2 else f"pc{i}") for i in range(k)])


# ---- exact Lloyd loop ------------------------------------------------------------
def assign(points: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Each point with the index of its nearest centre (lowest index on ties)."""
    return points.withColumn("cluster", V.nearest("p", centres))


def cluster_means(assigned: DataFrame) -> DataFrame:
    """Per-cluster mean point (double sums: any magnitude, last bits vary with the order)."""
    e = assigned.select("cluster", F.posexplode("p").alias("pos", "x"))
    g = e.groupBy("cluster", "pos").agg(
        F.avg("x").alias("m"),
        F.count(F.lit(1)).alias("n"))
    return g.groupBy("cluster").agg(
        F.max("n").alias("n_points"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centre"))


def lloyd_update(assigned: DataFrame, centres: list[list[float]]) -> tuple[list[list[float]], float, list[int]]:
    """New centres (an empty cluster keeps its centre), the total shift (sum
    over centres of the Euclidean move, C25) and the sizes, from points that
    are assigned already.  Collects k rows."""
    rows = {r["cluster"]: (list(r["centre"]), r["n_points"]) for r in cluster_means(assigned).collect()}
    new = [rows.get(i, (c, 0))[0] for i, c in enumerate(centres)]
    shift = sum(math.sqrt(sum((a - b) * (a - b) for a, b in zip(o, n))) for o, n in zip(centres, new))
    return new, shift, [rows.get(i, (c, 0))[1] for i, c in enumerate(centres)]


def grid_mean(x: Column) -> Column:
    """Mean of doubles as a sum of whole numbers of ``1 / GRID``: the same in
    any order and engine, and within half such a step of the exact mean."""
    whole = F.sum(F.when(F.abs(x) < FITS, F.floor(x * GRID + 0.5)).cast("decimal(38,0)")).cast("double")
    return F.when(F.max(F.abs(x)) < FITS, whole / (F.count(x).cast("double") * GRID)).otherwise(F.avg(x))


def _assigned_each(points: DataFrame, centres: dict[int, list[list[float]]]) -> DataFrame:
    """``p, k, cluster``: every point once for each k, with its nearest centre."""
    picks = F.array(*[F.struct(F.lit(k).alias("k"), V.nearest("p", c).alias("cluster")) for k, c in centres.items()])
    return points.select("p", F.explode(picks).alias("x")).select("p", "x.k", "x.cluster")


def lloyd_updates(points: DataFrame, centres: dict[int, list[list[float]]]) -> dict[int, tuple[list[list[float]], float]]:
    """For each k the new centres (an empty cluster keeps its centre) and the
    total shift (sum over centres of the Euclidean move, C25), from one scan.
    Collects a row per k and cluster."""
    if not centres:
        return {}
    dims = len(next(iter(centres.values()))[0])
    got = (_assigned_each(points, centres).groupBy("k", "cluster")
           .agg(*[grid_mean(F.col("p")[i]).alias(f"m{i}") for i in range(dims)]).collect())
    means = {(r["k"], r["cluster"]): [r[f"m{i}"] for i in range(dims)] for r in got}
    out = {}
    for k, old in centres.items():
        new = [means.get((k, i), c) for i, c in enumerate(old)]
        moves = [math.sqrt(sum((a - b) * (a - b) for a, b in zip(o, n))) for o, n in zip(old, new)]
        out[k] = new, float(sum(moves))
    return out


def initial_centres(points: DataFrame, k: int, seed: int = 0) -> list[list[float]]:
    """``k`` points drawn by the md5 of id and seed (a sample without
    replacement; distributed top-k, k rows to the driver)."""
    order = F.md5(F.concat_ws("-", F.col("id").cast("string"), F.lit(str(seed))).cast("binary"))
    rows = points.orderBy(order, "id").limit(k).select("p").collect()
    return [list(r["p"]) for r in rows]


@dataclass
class LloydResult:
    centres: list[list[float]]
    assigned: DataFrame
    passes: int
    shift: float
    used: list[list[float]]      # the centres that ``assigned`` belongs to


def lloyd_many(points: DataFrame, ks, seed: int = 0, threshold: float = THRESHOLD, max_passes: int = MAX_PASSES,
               centres: dict[int, list[list[float]]] | None = None) -> dict[int, LloydResult]:
    """M5 (exact rule) for several k at once: assign, update, stop when the
    total shift is at most ``threshold`` or after ``max_passes``.  On
    convergence the previous centres are kept (the update is only applied
    while the shift is large).

    A pass is one job over all k that haven't stopped; the points are written
    once, so passes read them instead of their lineage.  The starts of every
    k are the first of one drawn order.
    """
    ks = list(ks)
    pts = cut_lineage(points.select("id", "p"))
    if centres is None:
        drawn = initial_centres(pts, max(ks), seed)
        centres = {k: drawn[:k] for k in ks}
    state = {k: (centres[k], 0, float("inf")) for k in ks}
    last = dict(centres)                                        # the centres of the latest assignment
    for _ in range(max_passes):
        open_ = {k: c for k, (c, _, shift) in state.items() if shift > threshold and c}
        if not open_:
            break
        for k, (new, shift) in lloyd_updates(pts, open_).items():
            last[k] = state[k][0]
            state[k] = (new if shift > threshold else state[k][0], state[k][1] + 1, shift)
    return {k: LloydResult(c, assign(pts, last[k]), passes, shift, last[k])
            for k, (c, passes, shift) in state.items()}


def lloyd_kmeans(points: DataFrame, k: int, seed: int = 0, threshold: float = THRESHOLD,
                 max_passes: int = MAX_PASSES, centres: list[list[float]] | None = None) -> LloydResult:
    """``lloyd_many`` for one k."""
    return lloyd_many(points, [k], seed, threshold, max_passes, None if centres is None else {k: centres})[k]


def lloyd_step_table(points: DataFrame, centres: list[list[float]], ids: list[int] | None = None) -> DataFrame:
    """One Lloyd pass as a table: cluster, n_points, new centre, and the
    Euclidean move of that centre (empty clusters keep theirs, n = 0).
    ``ids`` names the clusters (default 0..k-1, in the order of ``centres``)."""
    spark = points.sparkSession
    ids = list(range(len(centres))) if ids is None else [int(i) for i in ids]
    assigned = assign(points, centres).withColumn(
        "cluster", F.element_at(F.array(*[F.lit(i) for i in ids]), F.col("cluster") + 1))
    means = cluster_means(assigned)
    old = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in zip(ids, centres)],
                                "cluster int, old array<double>")
    j = old.join(means, "cluster", "left")
    centre = F.coalesce(F.col("centre"), F.col("old"))
    return j.select("cluster", F.coalesce("n_points", F.lit(0)).alias("n_points"),
                    centre.alias("centre"), V.euclidean("old", centre).alias("shift"))


# ---- MLlib k-means -----------------------------------------------------------------
def mllib_kmeans(points: DataFrame, k: int, seed: int = 0, max_iter: int = MAX_PASSES,
                 tol: float = THRESHOLD):
    """M5 (scalable): MLlib k-means (k-means|| init; ``tol`` bounds each
    centre's move rather than the sum of moves)."""
    vec = points.select("id", array_to_vector("p").alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features",
                   predictionCol="cluster").fit(vec)
    out = model.transform(vec).select("id", "cluster", vector_to_array("features").alias("p"))
    return model, out


# ---- silhouette ------------------------------------------------------------------------
def cluster_stats(assigned: DataFrame) -> list[dict]:
    """Per-cluster count, coordinate sums and sum of squared norms (k rows)."""
    e = assigned.select("cluster", F.posexplode("p").alias("pos", "x"))
    sums = (e.groupBy("cluster", "pos").agg(F.sum("x").alias("s"))
            .groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))),
                                                lambda t: t["s"]).alias("sum_p")))
    norms = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(V.dot("p", "p")).alias("sum_sq"))
    return [r.asDict() for r in norms.join(sums, "cluster").orderBy("cluster").collect()]


def silhouette_points(assigned: DataFrame, stats: list[dict] | None = None) -> DataFrame:
    """Per-point silhouette for the squared Euclidean distance.

    Mean squared distance from x to cluster C:
        (n_C |x|^2 - 2 x . S_C + Q_C) / n_C     (S = sum of points, Q = sum of |y|^2)
    a(x) divides by n_C - 1 (x itself contributes 0), b(x) is the smallest
    mean over the other non-empty clusters; a singleton scores 0.  Points are
    taken about their global mean, which limits cancellation for data far
    from the origin, and totals that round below 0 count as 0.  ``stats``, if
    given, are those of ``assigned`` as it is.
    """
    if stats is None:
        mean = [r["m"] for r in assigned.select(F.posexplode("p").alias("pos", "x")).groupBy("pos")
                .agg(F.avg("x").alias("m")).orderBy("pos").collect()]       # one number per dimension
        if mean:
            about = assigned.withColumn("__p", F.col("p")).withColumn(
                "p", F.zip_with("p", V.literal_vector(mean), lambda x, m: x - m))
            return silhouette_points(about, cluster_stats(about)).withColumn("p", F.col("__p")).drop("__p")
        stats = []
    return assigned.withColumn("silhouette", _silhouette(F.col("cluster"), stats))


def _silhouette(cl: Column, stats: list[dict]) -> Column:
    """The silhouette of point ``p`` in cluster ``cl`` from all clusters' sums."""
    # all clusters' totals in one array, so that no product is computed twice
    xx = V.dot("p", "p")
    rows = F.array(*[F.struct(F.lit(int(s["cluster"])).alias("c"), F.lit(int(s["n"])).alias("n"), F.greatest(
        F.lit(float(s["n"])) * xx - 2.0 * V.dot("p", V.literal_vector(s["sum_p"])) + F.lit(float(s["sum_sq"])),
        F.lit(0.0)).alias("t")) for s in stats])
    parts = F.aggregate(rows, F.struct(F.lit(0).alias("n"), F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b")),
                        lambda acc, x: F.struct(
                            F.when(x["c"] == cl, x["n"]).otherwise(acc["n"]).alias("n"),
                            F.when((x["c"] == cl) & (x["n"] > 1), x["t"] / F.greatest(x["n"] - 1, F.lit(1)).cast("double"))
                            .otherwise(acc["a"]).alias("a"),
                            F.when(x["c"] != cl, F.least(acc["b"], x["t"] / x["n"].cast("double"))).otherwise(acc["b"]).alias("b")),
                        lambda acc: F.when((acc["n"] <= 1) | acc["b"].isNull(), F.lit(0.0)).otherwise(
                            F.try_divide(acc["b"] - acc["a"], F.greatest(acc["a"], acc["b"]))))
    return F.coalesce(parts, F.lit(0.0))


def mean_silhouettes(points: DataFrame, centres: dict[int, list[list[float]]]) -> dict[int, float]:
    """The mean silhouette of the points for every k, each point in the
    cluster of its nearest centre: one aggregate for the sums of all clusters
    of all k, one for all means."""
    mean = mean_point(points)
    if mean is None:
        return dict.fromkeys(centres, 0.0)
    # the nearest centre is told from the points as they are; the sums are of points about the mean
    each = _assigned_each(points, centres).withColumn(
        "p", F.zip_with("p", V.literal_vector(mean), lambda x, m: x - m))
    dims = range(len(mean))
    got = each.groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(V.dot("p", "p")).alias("sum_sq"),
                                           *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in dims]).collect()
    stats: dict[int, list[dict]] = {}
    for r in sorted(got, key=lambda r: (r["k"], r["cluster"])):
        stats.setdefault(r["k"], []).append({"cluster": r["cluster"], "n": r["n"], "sum_sq": r["sum_sq"],
                                             "sum_p": [r[f"s{i}"] for i in dims]})
    value = F.lit(None).cast("double")
    for k, st in stats.items():
        value = F.when(F.col("k") == k, _silhouette(F.col("cluster"), st)).otherwise(value)
    got = each.select("k", value.alias("s")).groupBy("k").agg(stable_mean("s").alias("s")).collect()
    scores = {r["k"]: float(r["s"]) for r in got}
    return {k: scores[k] for k in centres}


def mean_silhouette(assigned: DataFrame, stats: list[dict] | None = None) -> float:
    r = silhouette_points(assigned, stats).agg(F.avg("silhouette").alias("s")).first()
    return float(r["s"]) if r and r["s"] is not None else 0.0


def choose_k(points: DataFrame, ks=K_RANGE, seed: int = 0, method: str = "lloyd") -> DataFrame:
    """M7: silhouette for every k; the first k with the best score is chosen.

    ``lloyd`` runs all k together (``lloyd_many``, ``mean_silhouettes``);
    ``mllib`` makes one fit per k.  The points are written once.
    """
    pts = cut_lineage(points.select("id", "p"))
    ks = list(ks)
    if method == "lloyd":
        fits = lloyd_many(pts, ks, seed)
        scores = mean_silhouettes(pts, {k: f.used for k, f in fits.items()})
    else:
        scores = {k: mean_silhouette(mllib_kmeans(pts, k, seed)[1]) for k in ks}
    best = max(ks, key=lambda k: (scores[k], -k))
    return points.sparkSession.createDataFrame([(k, scores[k], int(k == best)) for k in ks],
                                               "k int, silhouette double, chosen int")


def cluster_report(assigned: DataFrame) -> DataFrame:
    """M8: per cluster the size, centre and mean silhouette (members stay in
    the assignment table rather than being gathered into one row)."""
    sil = silhouette_points(assigned)
    means = cluster_means(assigned)
    s = sil.groupBy("cluster").agg(F.avg("silhouette").alias("mean_silhouette"))
    return means.join(s, "cluster")


def centroid_distances(points: DataFrame, group_col: str = "label") -> DataFrame:
    """C23/C24 on real data: each point's Euclidean and Manhattan distance to
    the centroid of its group.

    The centroid table (one row per group) is written first, so the planner
    knows its true size: broadcast when it is small, a sort-merge join (with
    AQE splitting a hot group) when there are very many groups -- never a
    shuffle of all points on a handful of group keys.
    """
    means = cluster_means(points.withColumnRenamed(group_col, "cluster")) \
        .select(F.col("cluster").alias(group_col), "centre")
    j = points.join(cut_lineage(means, "centroids"), group_col)
    return j.select("id", group_col, V.euclidean("p", "centre").alias("euclidean"),
                    V.manhattan("p", "centre").alias("manhattan"))
