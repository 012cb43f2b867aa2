"""M3: boosted-tree redemption model on the assembled datasets.

``pyspark.ml`` GBT stands in for the original gradient-boosting library:
``stepSize`` = eta, ``maxDepth``, ``maxIter`` = rounds, ``subsamplingRate`` =
row subsample, ``featureSubsetStrategy`` = column sample (Spark samples per
node, not per tree or level).  ``min_child_weight`` maps loosely to
``minInstancesPerNode``; ``gamma`` and the L2 ``lambda`` have no equivalent.
Missing feature values are replaced by a sentinel below every real value
(trees then route "missing" to one side, like the original's default
direction).  Probabilities are therefore not comparable with the original,
rankings are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.session import cut_lineage, scratch_path

ID_COLUMNS = ("user_id", "coupon_id", "date_received")
MISSING = -999.0
TASK_ROWS = 250_000      # training rows of one task, which keeps them in memory while trees grow


@dataclass(frozen=True)
class Booster:
    eta: float
    depth: int
    rounds: int
    subsample: float = 1.0
    colsample: str = "all"
    min_child: int = 1


# The three published parameter sets.
MAIN_PARAMS = Booster(eta=0.01, depth=5, rounds=3000, subsample=0.9, colsample="0.7", min_child=1)
COMPACT_PARAMS = Booster(eta=0.03, depth=6, rounds=5, subsample=1.0, colsample="all", min_child=1)
USER_BLOCK_PARAMS = Booster(eta=0.01, depth=5, rounds=10, subsample=0.9, colsample="0.7", min_child=3)


def feature_columns(df: DataFrame, drop_ids: bool = True) -> list[str]:
    skip = {"label"} | (set(ID_COLUMNS) if drop_ids else set())
    return [c for c in df.columns if c not in skip]


def _numeric(c: str, dtype: str):
    col = F.col(f"`{c}`")
    if dtype == "date":   # ids kept as features: yyyymmdd number
        col = F.date_format(col, "yyyyMMdd").cast("double")
    return F.coalesce(col.cast("double"), F.lit(MISSING))


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    keep = [c for c in df.columns if c in ID_COLUMNS or c == "label"]
    filled = df.select(*[F.col(c) for c in keep],
                       *[_numeric(c, types[c]).alias(f"f{i}") for i, c in enumerate(features)])
    va = VectorAssembler(inputCols=[f"f{i}" for i in range(len(features))], outputCol="features")
    return va.transform(filled).select(*keep, "features")


@dataclass
class FittedModel:
    model: object
    features: list[str]
    data: DataFrame        # the written training rows: ids, label, features


def fit(train: DataFrame, params: Booster = MAIN_PARAMS, rounds: int | None = None,
        drop_ids: bool = True, seed: int = 0) -> FittedModel:
    """Fit on the training rows, written once (GBT runs many jobs) and dealt
    evenly to tasks of at most about ``TASK_ROWS``, as written files hold any
    number of rows each; ``rounds=None`` means the parameter set's own."""
    feats = feature_columns(train, drop_ids)
    data = cut_lineage(assemble(train, feats).withColumn("label", F.col("label").cast("double")))
    rows = data.count()      # from the files' footers
    if rows > TASK_ROWS:
        data = data.repartition(max(-(-rows // TASK_ROWS), data.sparkSession.sparkContext.defaultParallelism))
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=params.rounds if rounds is None else rounds,
                        stepSize=params.eta, maxDepth=params.depth, subsamplingRate=params.subsample,
                        featureSubsetStrategy=params.colsample, minInstancesPerNode=params.min_child,
                        seed=seed, lossType="logistic")
    return FittedModel(gbt.fit(data), feats, data)


def score(fm: FittedModel, rows: DataFrame) -> DataFrame:
    """(user_id, coupon_id, date_received, prob) for every row."""
    out = fm.model.transform(assemble(rows, fm.features))
    return out.select(*ID_COLUMNS, vector_to_array("probability")[1].alias("prob"))


def train_auc(fm: FittedModel, train: DataFrame | None = None) -> float:
    """Area under the ROC curve on the rows the model was fitted on, or on ``train``."""
    rows = fm.data if train is None else assemble(train, fm.features).withColumn("label", F.col("label").cast("double"))
    out = fm.model.transform(rows)
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC").evaluate(out)


def importance(fm: FittedModel) -> DataFrame:
    """Per feature the number of splits using it (the original's default
    score), plus Spark's gain-based importance; sorted by split count.

    The trees are written to the shared checkpoint folder and read back as a
    table, so the count is a Spark aggregate over the tree nodes.
    """
    spark = fm.model.sparkSession if hasattr(fm.model, "sparkSession") else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    path = scratch_path(spark, f"gbt-{uuid.uuid4().hex}")
    fm.model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    splits = (nodes.where(F.col("nodeData.leftChild") >= 0)
              .groupBy(F.col("nodeData.split.featureIndex").alias("idx"))
              .agg(F.count(F.lit(1)).alias("split_count")))
    gains = fm.model.featureImportances.toArray().tolist()
    names = spark.createDataFrame([(i, n, float(gains[i])) for i, n in enumerate(fm.features)],
                                  "idx int, feature_name string, gain_importance double")
    return (names.join(splits, "idx", "inner")
            .select("feature_name", F.col("split_count").cast("bigint").alias("importance"), "gain_importance")
            .orderBy(F.desc("importance"), "feature_name"))
