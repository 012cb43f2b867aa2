"""Report invariants and exact quantiles against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from promo_engine.operators import reports as R
from promo_engine.operators.quantiles import exact_quantiles
from promo_engine.plans.catalog import QUERIES
from promo_engine.sources.generated import random_int_table


def test_shares_sum_to_one(spark, sf):
    for q in ("coupon_type_share", "coupon_type_share_positive", "label_share"):
        s = QUERIES[q](spark, sf).agg(F.sum("share")).first()[0]
        assert s == pytest.approx(1.0)


def test_rate_bounds(spark, sf):
    rows = QUERIES["label_rate_by_distance"](spark, sf).collect()
    assert [r.distance for r in sorted(rows)] == list(range(11))
    assert all(r.positive_rate is None or 0 <= r.positive_rate <= 1 for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    a = np.concatenate([rng.normal(size=3000), np.repeat(0.5, 400)])
    b = rng.integers(0, 7, size=1201).astype(float)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    long = spark.createDataFrame(rows, "column_name string, value double").repartition(5)
    q = exact_quantiles(long, (0.25, 0.5, 0.75))
    for name, arr in (("a", a), ("b", b)):
        assert q[name] == pytest.approx(list(np.percentile(arr, [25, 50, 75])), rel=0, abs=1e-12)


def test_box_stats_random_table(spark):
    t = random_int_table(spark)
    assert t.count() == 10
    vals = t.select("A", "B").toPandas()
    assert vals.min().min() >= 1 and vals.max().max() < 50
    bs = {r.column_name: r for r in R.box_stats(t, ["A", "B"]).collect()}
    for c in ("A", "B"):
        x = vals[c].to_numpy(dtype=float)
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        assert bs[c].median == pytest.approx(med)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = x[(x >= lo) & (x <= hi)]
        assert bs[c].whisker_low == inside.min() and bs[c].whisker_high == inside.max()
        assert bs[c].n_outliers == int(((x < lo) | (x > hi)).sum())


def test_box_stats_adds_up_where_rows_are_read(spark):
    """No join brings all rows of a column together, and a column without values keeps its row."""
    rows = [(float(x), None) for x in range(100)] + [(1e6, None), (float("nan"), None), (None, None)]
    bs = R.box_stats(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    assert "SortMergeJoin" not in bs._jdf.queryExecution().executedPlan().toString()
    got = {r.column_name: tuple(r)[1:] for r in bs.collect()}
    assert got == {"a": (25.0, 50.0, 75.0, 0.0, 99.0, 1), "b": (None, None, None, None, None, 0)}


def test_column_sums_share(spark):
    t = random_int_table(spark)
    rows = R.column_sums(t, ["A", "B", "C"]).collect()
    assert sum(r.share for r in rows) == pytest.approx(1.0)
    pdf = t.toPandas()
    assert {r.column_name: r.total for r in rows}["A"] == pytest.approx(pdf["A"].sum())


def test_null_profile(spark, sf):
    rows = {r.column_name: r for r in QUERIES["null_profile"](spark, sf).collect()}
    assert rows["user_id"].has_null == 0
    assert rows["coupon_id"].has_null == 1 and 0 < rows["coupon_id"].null_ratio < 1
