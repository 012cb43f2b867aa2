"""Grouped exact medians: selection from counts, hot keys, and the plan of the user block."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from promo_engine.functions.coupon import stable_mean
from promo_engine.operators import features as FT
from promo_engine.operators import quantiles as Q
from promo_engine.plans import catalog as K


def _counted(df):
    return df.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("most, parts", [(250_000, 64), (100, 8), (3, 2)])
def test_medians_are_numpys(spark, most, parts):
    rng = np.random.default_rng(1)
    rows = [(0, float(v)) for v in rng.lognormal(0, 8, 4000)]                      # a third of all rows, all distinct
    rows += [(1, float(v)) for v in 1e9 + rng.integers(0, 1500, 3001)]              # a narrow range far from 0
    rows += [(int(k), float(v)) for k, v in zip(rng.integers(2, 400, 4000), rng.integers(-5, 6, 4000))]
    rows += [(None, 1.0), (None, 2.0), (500, 1e308), (500, 1.5e308), (501, -0.5), (502, 5e-324), (502, 5e-324)]
    rows += [(503, 7.0)] * 500 + [(503, float(v)) for v in range(100, 400)]         # one value holds the middle
    df = spark.createDataFrame(rows, "k int, value double").repartition(8)
    got = {r.k: r.median for r in Q.grouped_medians(_counted(df), ["k"], most, parts).collect()}
    by = {}
    for k, v in rows:
        by.setdefault(k, []).append(v)
    assert set(got) == set(by)
    for k, v in by.items():
        v = sorted(v)
        a, b = v[(len(v) - 1) // 2], v[len(v) // 2]
        assert got[k] == (a if a == b else a * 0.5 + b * 0.5), k


def test_medians_of_nothing(spark):
    none = spark.createDataFrame([], "k int, value double, n bigint")
    assert Q.grouped_medians(none, ["k"]).count() == 0


def test_hot_key_never_meets_in_one_task(spark):
    """A user with a third of the rows and as many values: what one range holds at the end is bounded."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 1000).alias("k"),
                                    (F.col("id") * 7919 % 60_013).cast("double").alias("value"))
    counts = _counted(df)
    sizes = counts.groupBy("k").agg(F.count(F.lit(1)).alias("__rows"), F.sum("n").alias("__all"))
    left = Q._narrowed(counts, sizes, ["k"], "__p", 1000, 64)
    assert left.groupBy("k", "__p").count().agg(F.max("count")).first()[0] <= 2 * 20_000 / 64
    got = {r.k: r.median for r in Q.grouped_medians(counts, ["k"], most=1000).where("k < 3").collect()}
    want = {r.k: r.m for r in df.where("k < 3").groupBy("k").agg(F.median("value").alias("m")).collect()}
    assert got == want


def test_user_block_has_no_object_aggregate(spark, sf):
    history, label = K.fields(spark, sf)
    specs = [s for s in FT.MAIN_SPECS if s.keys == (FT.U,) and s.src == "H"]
    t = FT.aggregate_block(FT.prepare_label_field(label), history, (FT.U,), specs)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "HashAggregate" in plan
    used = history.where("date_used is not null and coupon_id is not null and user_id is not null")
    want = {r.user_id: r.m for r in used.groupBy("user_id").agg(F.median("distance").cast("double").alias("m")).collect()}
    got = {r.user_id: r.receive_buy_median_distance for r in t.collect() if r.receive_buy_median_distance is not None}
    assert got == want


def test_stable_mean_of_many_large_values(spark):
    df = spark.range(200_000).select(F.lit(9e14).alias("x"))
    assert df.agg(stable_mean("x")).first()[0] == pytest.approx(9e14, rel=1e-12)
