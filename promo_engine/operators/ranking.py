"""Area under the ROC curve by ranks, exact and aware of ties.

The rows are counted by (group, score); a positive row beats every negative
row with a smaller score and half of those with the same one.  The counts are
laid out by ranges of (group, score), each range's totals are added up in
order (a few numbers per range), and the running counts inside a range start
from there.  So a group of any number of scores is spread over many tasks,
and the sums are whole numbers: the result does not depend on the layout.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.session import cut_lineage

RANGE_ROWS = 1_000_000   # distinct (group, score) rows of one range, about


def score_counts(rows: DataFrame, groups: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """``groups..., score, pos, neg``; rows without score, or with a label other than 0 or 1, count for nothing."""
    known = rows.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    return known.groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def rank_auc(rows: DataFrame, groups: list[str], score: str = "score", label: str = "label",
             range_rows: int = RANGE_ROWS) -> DataFrame:
    """``groups..., n_pos, n_neg, auc``: one row per group (a null group is
    one of its own); ``auc`` is null where a class has no rows."""
    counts = cut_lineage(score_counts(rows, groups, score, label), "auc-counts")
    parts = max(1, math.ceil(counts.count() / range_rows))
    ranged = cut_lineage(counts.repartitionByRange(parts, *groups, "score").withColumn("__range", F.spark_partition_id()),
                         "auc-ranges")
    # what stands before a range in its group: one row per range and group
    before = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    per = (ranged.groupBy(*groups, "__range").agg(F.sum("neg").alias("__neg"))
           .withColumn("__before", F.coalesce(F.sum("__neg").over(before), F.lit(0))).drop("__neg"))
    other = per.select(*[F.col(c).alias(f"__r_{c}") for c in (*groups, "__range")], "__before")
    same: Column = reduce(lambda a, b: a & b, [ranged[c].eqNullSafe(other[f"__r_{c}"]) for c in (*groups, "__range")])
    inside = Window.partitionBy(*groups, "__range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("__before") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    whole = lambda c: c.cast("decimal(20,0)")
    halves = whole(F.col("pos")) * whole(2 * F.col("__below") + F.col("neg"))      # twice the rows beaten
    out = (ranged.join(other, same).withColumn("__below", below).groupBy(*groups)
           .agg(F.sum(halves).alias("__halves"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return out.select(*groups, "n_pos", "n_neg", F.try_divide(F.col("__halves").cast("double") / 2.0, pairs).alias("auc"))
