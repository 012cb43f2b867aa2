"""M6: silhouette in the plain Euclidean distance, exact.

A point needs its mean distance to its own cluster and to the nearest other
one.  The mean distance to a cluster lies between the distance to its centre
and that distance plus the cluster's mean radius (triangle inequality), so
clusters whose lower bound exceeds another's upper bound can't be nearest and
are skipped.  What is left are sums of distances from points to whole
clusters.  Clusters are cut into blocks of bounded size, and so are the points
that ask for them; each cell of two blocks adds up its distances, and only a
sum per point leaves it.  The work is that of the distances that are needed
(all within a cluster at least), memory is that of two blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promo_engine.functions import vectors as V
from promo_engine.session import cut_lineage

BLOCK = 1 << 14       # rows of a block; all blocks travel once for each one they meet, so smaller ones cost shuffles
PAIRS = 1 << 17       # distances held at once
CLOSE = 1e-4          # of two points' squared lengths: squared distances below it are taken by differences
SLACK = 1e-9          # of the bounds, for rounding


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to those beside them in ``b``, by differences (no cancellation)."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def distance_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For every row of ``x`` the sum of its distances to the rows of ``y``.

    Products of matrices give squared distances fast, and with all digits but
    for pairs that lie close together for their distance from the middle;
    these are taken by differences, as are all if squares leave the range of
    doubles."""
    out = np.zeros(len(x))
    if not x.size or not y.size:
        return out
    with np.errstate(over="ignore", invalid="ignore"):
        middle = y.mean(axis=0)
        cx, cy = x - middle, y - middle
        xx, yy = np.einsum("ij,ij->i", cx, cx), np.einsum("ij,ij->i", cy, cy)
        plain = np.isfinite(4 * (xx.max() + yy.max()))
        for lo in range(0, len(x), max(1, PAIRS // len(y))):
            part = slice(lo, lo + max(1, PAIRS // len(y)))
            if not plain:
                for i in range(lo, min(part.stop, len(x))):
                    out[i] = np.sqrt(_squares(x[i], y)).sum()
                continue
            both = xx[part, None] + yy
            square = cx[part] @ cy.T
            square *= -2
            square += both
            both *= CLOSE
            i, j = np.nonzero(square < both)
            for at in range(0, len(i), PAIRS // 8):
                a, b = i[at:at + PAIRS // 8], j[at:at + PAIRS // 8]
                square[a, b] = _squares(x[lo + a], y[b])
            out[part] = np.sqrt(square, out=square).sum(axis=1)
    return out


def _matrix(t: pa.Table) -> np.ndarray:
    return np.asarray(t.column("p").combine_chunks().flatten(), dtype=np.float64).reshape(t.num_rows, -1)


def _cell(asking: pa.Table, members: pa.Table) -> pa.Table:
    sums, rows = np.empty(0), pa.array([], type=pa.int64())
    target = pa.array([], type=pa.int64())
    if asking.num_rows and members.num_rows:
        sums = distance_sums(_matrix(asking), _matrix(members))
        rows, target = asking.column("row").combine_chunks(), asking.column("target").combine_chunks()
    return pa.table([rows, target, pa.array(sums, type=pa.float64())], names=["row", "target", "s"])


def _clusters(points: DataFrame) -> list[dict]:
    """Per cluster its number, count, centre and mean radius (a row per cluster)."""
    dims = points.select(F.size("p").alias("n")).first()
    if dims is None:
        return []
    means = points.groupBy("c").agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("p")[i]).alias(f"m{i}") for i in range(dims["n"])])
    out = {r["c"]: {"c": r["c"], "n": r["n"], "centre": [r[f"m{i}"] for i in range(dims["n"])]} for r in means.collect()}
    away: Column = F.lit(None).cast("double")
    for c, s in out.items():
        away = F.when(F.col("c") == c, V.euclidean("p", V.literal_vector(s["centre"]))).otherwise(away)
    for r in points.groupBy("c").agg(F.avg(away).alias("radius")).collect():
        out[r["c"]]["radius"] = r["radius"]
    return [out[c] for c in sorted(out)]


def _asked(points: DataFrame, clusters: list[dict]) -> DataFrame:
    """``row, p, target``: the clusters whose distances a point needs."""
    near = F.array(*[F.struct(F.lit(s["c"]).cast("bigint").alias("c"), F.lit(s["radius"]).alias("radius"),
                              V.euclidean("p", V.literal_vector(s["centre"])).alias("d")) for s in clusters])
    others = F.filter(near, lambda x: x["c"] != F.col("c"))
    most = F.array_min(F.transform(others, lambda x: x["d"] + x["radius"]))
    rows = points.withColumn("others", others).withColumn("most", most)
    needed = F.filter("others", lambda x: x["d"] <= F.col("most") * (1 + SLACK))
    alone = F.array(*[F.lit(s["c"]).cast("bigint") for s in clusters if s["n"] == 1]).cast("array<bigint>")
    own = F.when(~F.array_contains(alone, F.col("c")), F.array("c")).otherwise(F.array().cast("array<bigint>"))
    targets = F.concat(own, F.when(F.size(own) > 0, F.transform(needed, lambda x: x["c"])).otherwise(F.array().cast("array<bigint>")))
    return rows.select("row", "p", F.explode(targets).alias("target"))


def euclidean_silhouette(assigned: DataFrame, block: int = BLOCK) -> DataFrame:
    """``assigned`` (``p`` array<double>, ``cluster``) with ``silhouette``.

    A point alone in its cluster, and every point of a single cluster, scores
    0; so does a point whose distances are all 0.  Rows without point or
    cluster, or with a part that is no finite number, score null and count
    for no cluster.
    """
    whole = F.coalesce(F.forall("p", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = cut_lineage(assigned.withColumn("__row", F.monotonically_increasing_id()), "silhouette-points")
    points = rows.where(F.col("cluster").isNotNull() & whole).select(
        F.col("__row").alias("row"), F.col("cluster").cast("bigint").alias("c"), V.as_doubles("p").alias("p"))
    clusters = _clusters(points)
    if not clusters:
        return rows.drop("__row").withColumn("silhouette", F.lit(None).cast("double"))
    asked = cut_lineage(_asked(points, clusters), "silhouette-asked")
    spark = assigned.sparkSession
    wanted = {r["target"]: r["n"] for r in asked.groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = lambda n: max(1, -(-n // block))
    grid = F.broadcast(spark.createDataFrame([(s["c"], s["n"], parts(wanted.get(s["c"], 0)), parts(s["n"])) for s in clusters],
                                             "target bigint, size bigint, askers int, members int"))      # a row per cluster
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ask = (asked.join(grid, "target").withColumn("a", F.pmod(F.xxhash64("row"), F.col("askers")).cast("int"))
           .withColumn("m", spread("members")).select("target", "a", "m", "row", "p"))
    have = (points.withColumnRenamed("c", "target").join(grid, "target")
            .withColumn("m", F.pmod(F.xxhash64("row"), F.col("members")).cast("int")).withColumn("a", spread("askers"))
            .select("target", "a", "m", "p"))
    key = ["target", "a", "m"]
    sums = (ask.groupBy(key).cogroup(have.groupBy(key)).applyInArrow(_cell, "row bigint, target bigint, s double")
            .groupBy("row", "target").agg(F.sum("s").alias("s")))
    mine = points.select("row", "c")
    to = sums.join(grid.select("target", "size"), "target").join(mine, "row")
    score = to.groupBy("row").agg(
        F.max(F.when(F.col("target") == F.col("c"), F.col("s") / (F.col("size") - 1))).alias("a"),
        F.min(F.when(F.col("target") != F.col("c"), F.col("s") / F.col("size"))).alias("b"))
    value = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    known = mine.join(score, "row", "left").select(F.col("row").alias("__row"), value.alias("silhouette"))
    return rows.join(known, "__row", "left").drop("__row")
