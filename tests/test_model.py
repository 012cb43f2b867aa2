"""Boosted trees: learns a separable signal, deterministic, importance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from promo_engine.operators import model as MD


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n = 400
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = (a + 0.2 * b > 0).astype(int)
    rows = [(int(i), int(i % 7), None, float(a[i]), float(b[i]) if i % 10 else None, int(y[i]))
            for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, coupon_id long, date_received date, "
                                       "fa double, fb double, label int")


def test_auc_and_determinism(spark, data):
    fm = MD.fit(data, MD.COMPACT_PARAMS, rounds=10, seed=3)
    assert fm.features == ["fa", "fb"]
    assert MD.train_auc(fm, data) > 0.95
    p1 = [r.prob for r in MD.score(fm, data).orderBy("user_id").collect()]
    fm2 = MD.fit(data, MD.COMPACT_PARAMS, rounds=10, seed=3)
    p2 = [r.prob for r in MD.score(fm2, data).orderBy("user_id").collect()]
    assert p1 == p2


def test_importance(spark, data):
    fm = MD.fit(data, MD.COMPACT_PARAMS, rounds=5, seed=3)
    imp = MD.importance(fm).collect()
    gain = {r.feature_name: r.gain_importance for r in imp}
    assert gain["fa"] > gain.get("fb", 0.0)
    internal = sum((t.numNodes - 1) // 2 for t in fm.model.trees)
    assert sum(r.importance for r in imp) == internal
    assert all(r.importance > 0 for r in imp)
    assert [r.importance for r in imp] == sorted([r.importance for r in imp], reverse=True)


def test_training_rows_are_dealt_to_tasks(spark, monkeypatch):
    """One file of many rows is not one task's training data."""
    monkeypatch.setattr(MD, "TASK_ROWS", 100, raising=False)
    rows = spark.range(1000).coalesce(1).select(F.col("id").alias("user_id"), F.lit(1).alias("coupon_id"),
                                                F.lit("2016-01-01").cast("date").alias("date_received"),
                                                (F.col("id") % 7).alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    fm = MD.fit(rows, MD.Booster(eta=0.1, depth=2, rounds=1))
    sizes = [r["count"] for r in fm.data.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 110
