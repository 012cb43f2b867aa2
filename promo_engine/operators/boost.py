"""M3: boosted trees that can be watched, stopped and resumed.

Each round fits one of Spark's regression trees to the gradient of the
logistic loss, weighted by its curvature, so a split's gain and a leaf's
value are those of a second-order booster; leaves are shrunk by the L2 term.
Rows are sampled per round by a hash of their number, columns per tree, and
again per node inside the tree.

The training rows live in a written table with their margin.  After every
``batch`` rounds one scan adds the batch's trees to the margins and writes
the table anew beside the trees and, if asked for, the AUC of each round on
every set.  A batch folder counts once its trees are written, which is the
last step: a run that dies in between starts again from the last whole
batch, and a finished model can be trained further.  Trees are evaluated as
column expressions, in the JVM; a batch of them is too large for one compiled
method, so these jobs run with code that is cut into several
(``_small_methods``).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promo_engine.operators import model as MD
from promo_engine.operators.ranking import rank_auc

BATCH = 25
CURVATURE = 1e-16       # least weight of a row, as margins run away
_TREES = "round int, id int, left int, right int, feature int, threshold double, value double, gain double"


@contextmanager
def _small_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs planned inside compile projections, whose code Spark splits, instead of whole stages."""
    name = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder; ``left`` and ``right`` are node numbers, -1 in a leaf."""
    round: int
    nodes: list[tuple] = field(repr=False)          # (id, left, right, feature, threshold, value, gain)

    def value(self, features: str) -> Column:
        """The tree's value for a row as nested conditions."""
        return F.expr(self._sql(0, features))

    def _sql(self, at: int, features: str) -> str:
        _, left, right, feature, threshold, value, _ = self.nodes[at]
        if left < 0:
            return f"CAST({value!r} AS DOUBLE)"
        return (f"CASE WHEN {features}[{feature}] <= CAST({threshold!r} AS DOUBLE) THEN {self._sql(left, features)} "
                f"ELSE {self._sql(right, features)} END")


def read_tree(model, round_: int, columns: list[int], l2: float) -> Tree:
    """The tree of a fitted one-tree forest, its features numbered as in the
    training table, its leaves shrunk by ``weight / (weight + l2)``."""
    nodes: list[tuple] = []

    def walk(node) -> int:
        at = len(nodes)
        nodes.append(())
        if node.subtreeDepth() == 0:
            weight = float(node.impurityStats().stats()[0])
            value = float(node.prediction()) * weight / (weight + l2) if weight + l2 > 0 else 0.0
            nodes[at] = (at, -1, -1, -1, 0.0, value, 0.0)
        else:
            split = node.split()
            left, right = walk(node.leftChild()), walk(node.rightChild())
            nodes[at] = (at, left, right, columns[split.featureIndex()], float(split.threshold()), 0.0, float(node.gain()))
        return at
    walk(model.trees[0]._java_obj.rootNode())
    return Tree(round_, nodes)


def training_table(sets: dict[str, DataFrame], features: list[str]) -> DataFrame:
    """``row, set, label, f, margin``: the numbered rows of the named sets with their features as an array."""
    out = None
    for name, df in sets.items():
        types = dict(df.dtypes)
        part = df.select(F.lit(name).alias("set"), F.col("label").cast("double").alias("label"),
                         F.array(*[MD._numeric(c, types[c]) for c in features]).alias("f"))
        out = part if out is None else out.unionByName(part)
    return out.select(F.monotonically_increasing_id().alias("row"), "*", F.lit(0.0).alias("margin"))


class Run:
    """A training run in a folder of the shared file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _done(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def batches(self) -> list[int]:
        """First rounds of the whole batches, in order."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [re.fullmatch(r"trees-(\d+)", s.getPath().getName()) for s in fs.listStatus(p)]
        return sorted(int(m[1]) for m in names if m and self._done(f"{self.folder}/{m[0]}"))

    def _path(self, kind: str, first: int) -> str:
        return f"{self.folder}/{kind}-{first:06d}"

    def start(self, table: DataFrame) -> None:
        if not self._done(self._path("rows", 0)):
            table.write.mode("overwrite").parquet(self._path("rows", 0))

    def rounds(self) -> int:
        """Rounds that are finished."""
        last = self.batches()[-1:]
        return 1 + self.spark.read.schema(_TREES).parquet(self._path("trees", last[0])).agg(F.max("round")).first()[0] \
            if last else 0

    def rows(self) -> DataFrame:
        """The training table with its margins after all finished rounds (``margins``: after each round of
        the last batch)."""
        return self.spark.read.parquet(self._path("rows", self.rounds()))

    def trees(self) -> list[Tree]:
        """All trees (model state: rounds times nodes of a tree)."""
        got: dict[int, list[tuple]] = {}
        for b in self.batches():
            for r in self.spark.read.schema(_TREES).parquet(self._path("trees", b)).collect():
                got.setdefault(r["round"], []).append(tuple(r)[1:])
        return [Tree(k, sorted(v)) for k, v in sorted(got.items())]

    def nodes(self) -> DataFrame:
        return self.spark.read.schema(_TREES).parquet(*[self._path("trees", b) for b in self.batches()])

    def watched(self) -> DataFrame:
        """``round, set, n_pos, n_neg, auc`` of every finished round."""
        return self.spark.read.parquet(*[self._path("watch", b) for b in self.batches()])


def _sampled(rows: DataFrame, share: float, round_: int, seed: int) -> DataFrame:
    if share >= 1:
        return rows
    return rows.where(F.pmod(F.xxhash64("row", F.lit(seed), F.lit(round_)), F.lit(1_000_000)) < int(share * 1_000_000))


def staged(rows: DataFrame, trees: list[Tree], eta: float) -> DataFrame:
    """``rows`` with ``margins``: the margin after each of ``trees``, from ``margin`` on, in one scan."""
    values = F.array(*[t.value("f") for t in trees])
    run = F.aggregate(values, F.array("margin"), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + eta * v)))
    return rows.withColumn("margins", F.slice(run, 2, len(trees)))


def boost(spark: SparkSession, folder: str, table: DataFrame | None, params: MD.Booster, rounds: int | None = None,
          train_sets: tuple[str, ...] = ("train",), batch: int = BATCH, watch: bool = True, l2: float = 1.0,
          seed: int = 0, max_bins: int = 32) -> Run:
    """Train up to ``rounds`` rounds (the parameter set's own by default) in
    ``folder``, going on from what is finished there.

    ``table`` is a ``training_table``; it is written when the run starts and
    not read when it goes on.  The model learns from ``train_sets``; with
    ``watch`` every set of the table gets an AUC per round.  An empty training
    set, or one class alone, gives trees of one leaf.
    """
    run = Run(spark, folder)
    if table is not None:
        run.start(table)
    with _small_methods(spark):
        _train(run, params, rounds, train_sets, batch, watch, l2, seed, max_bins)
    return run


def _train(run: Run, params: MD.Booster, rounds: int | None, train_sets: tuple[str, ...], batch: int, watch: bool,
           l2: float, seed: int, max_bins: int) -> None:
    spark = run.spark
    total = params.rounds if rounds is None else rounds
    share = 1.0 if params.colsample == "all" else float(params.colsample)
    done = run.rounds()
    while done < total:
        base = spark.read.parquet(run._path("rows", done)).drop("margins")
        width = base.select(F.size("f").alias("n")).first()
        if width is None:
            raise ValueError("no training rows")
        count = min(batch, total - done)
        trees: list[Tree] = []
        current = base.where(F.col("set").isin(*train_sets))
        for r in range(done, done + count):
            pick = random.Random(seed * 1_000_003 + r)
            columns = sorted(pick.sample(range(width["n"]), max(1, round(share * width["n"]))))
            p = 1.0 / (1.0 + F.exp(-F.col("margin")))
            weight = F.greatest(p * (1.0 - p), F.lit(CURVATURE))
            data = _sampled(current, params.subsample, r, seed).select(
                ((F.col("label") - p) / weight).alias("target"), weight.alias("weight"),
                array_to_vector(F.array(*[F.col("f")[i] for i in columns])).alias("x"))
            forest = RandomForestRegressor(
                featuresCol="x", labelCol="target", weightCol="weight", numTrees=1, maxDepth=params.depth, maxBins=max_bins,
                bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy=params.colsample,
                minInstancesPerNode=params.min_child, seed=seed + r)
            tree = read_tree(forest.fit(data), r, columns, l2)
            trees.append(tree)
            current = current.withColumn("margin", F.col("margin") + params.eta * tree.value("f"))
        grown = run._path("rows", done + count)
        (staged(base, trees, params.eta).withColumn("margin", F.element_at("margins", -1))
         .write.mode("overwrite").parquet(grown))
        if watch:
            per = spark.read.parquet(grown).select("set", "label", F.posexplode("margins").alias("at", "score"))
            auc = rank_auc(per.withColumn("round", F.col("at") + done), ["round", "set"])
            auc.write.mode("overwrite").parquet(run._path("watch", done))
        spark.createDataFrame([(t.round, *n) for t in trees for n in t.nodes], _TREES).coalesce(1) \
            .write.mode("overwrite").parquet(run._path("trees", done))
        done += count


def predictions(run: Run, rows: DataFrame, features: list[str], eta: float, batch: int = BATCH) -> DataFrame:
    """(user_id, coupon_id, date_received, prob) of every row, by all trees of the run."""
    types = dict(rows.dtypes)
    out = rows.select(*MD.ID_COLUMNS, F.array(*[MD._numeric(c, types[c]) for c in features]).alias("f"),
                      F.lit(0.0).alias("margin"))
    trees = run.trees()
    with _small_methods(run.spark):
        for lo in range(0, len(trees), batch):                     # a plan holds one batch of trees
            out = MD.cut_lineage(staged(out, trees[lo:lo + batch], eta).withColumn(
                "margin", F.element_at("margins", -1)).drop("margins"), "boost-score")
    return out.select(*MD.ID_COLUMNS, (1.0 / (1.0 + F.exp(-F.col("margin")))).alias("prob"))


def importance(run: Run, features: list[str]) -> DataFrame:
    """Per feature the number of splits that use it and their summed gain, most used first."""
    names = run.spark.createDataFrame(list(enumerate(features)), "feature int, feature_name string")
    return (run.nodes().where("left >= 0").groupBy("feature").agg(F.count(F.lit(1)).alias("importance"),
                                                                  F.sum("gain").alias("gain_importance"))
            .join(F.broadcast(names), "feature").select("feature_name", "importance", "gain_importance")
            .orderBy(F.desc("importance"), "feature_name"))
