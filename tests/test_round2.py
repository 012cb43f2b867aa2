"""Behaviour outside the fixtures' value ranges."""

import datetime as dt
import inspect

import pytest
from pyspark.sql import functions as F

from promo_engine.functions.coupon import stable_mean
from promo_engine.operators import cluster as CU
from promo_engine.operators import model as MD
from promo_engine.operators import reports as R
from promo_engine.plans import catalog
from promo_engine.plans import jobs as J
from promo_engine.sources import files as FL


def _points(spark, scale, shift=0.0):
    rows = [(i, 0 if i < 20 else 1, [shift + scale * (i % 5 + (0 if i < 20 else 40)), shift + scale * (i % 7)])
            for i in range(40)]
    return spark.createDataFrame(rows, "id long, cluster int, p array<double>")


@pytest.mark.parametrize("scale, shift", [(1e-6, 0.0), (1.0, 0.0), (1e5, 0.0), (1e12, 0.0), (1.0, 1e6)])
def test_silhouette_at_any_scale(spark, scale, shift):
    got = [r.silhouette for r in CU.silhouette_points(_points(spark, scale, shift)).orderBy("id").collect()]
    want = [r.silhouette for r in CU.silhouette_points(_points(spark, 1.0)).orderBy("id").collect()]
    assert all(-1 <= s <= 1 for s in got)
    assert got == pytest.approx(want, abs=1e-6)


def test_wholesale_clustering(spark, tmp_path):
    p = str(tmp_path / "wholesale")
    rows = [(1, 2, 100.0 + 7 * i if i % 2 else 90_000.0 + 1000 * i, 3.0 * i, 112_000.0 - i) for i in range(22)]
    spark.createDataFrame(rows, ["Channel", "Region", "a", "b", "c"]).coalesce(1).write.option("header", True).csv(p)
    res = J.clustering_job(spark, "wholesale", p, ks=range(2, 4))
    assert all(-1 <= r.silhouette <= 1 for r in res.scores.collect())


def test_sums_and_means_of_large_values(spark):
    df = spark.createDataFrame([(2e9, 1e30), (3e9, 1e30)], "a double, b double")
    assert {r.column_name: r.total for r in R.column_sums(df, ["a", "b"]).collect()} == {"a": 5e9, "b": 2e30}
    thirds = spark.createDataFrame([(1 / 3,), (2 / 3,), (1e-12,)], "x double")
    assert thirds.agg(stable_mean("x")).first()[0] == pytest.approx((1 + 1e-12) / 3, rel=1e-15)
    assert df.agg(stable_mean("b")).first()[0] == 1e30


def test_box_stats_edges(spark):
    inf, nan = float("inf"), float("nan")
    schema = "a double, b double, c double, d double"
    empty = R.box_stats(spark.createDataFrame([], schema), ["a", "b"]).collect()
    assert [(r.q1, r.median, r.n_outliers) for r in empty] == [(None, None, 0)] * 2
    rows = [(1.0, None, 5.0, -1.7e308), (2.0, None, 5.0, 1.7e308), (inf, None, 5.0, nan), (4.0, None, 5.0, 0.0)]
    got = {r.column_name: r for r in R.box_stats(spark.createDataFrame(rows, schema), list("abcd")).collect()}
    assert (got["a"].median, got["a"].whisker_low) == (3.0, 1.0)
    assert got["b"].median is None and got["b"].n_outliers == 0
    assert (got["c"].q1, got["c"].whisker_high, got["c"].n_outliers) == (5.0, 5.0, 0)
    assert got["d"].median == 0.0


def test_whitespace_reader_ragged(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1 2\n 3\t4  5 \n\n6\n")
    got = FL.read_whitespace_text(spark, str(tmp_path / "t.txt"))
    assert got.columns == ["_c0", "_c1", "_c2"]
    assert sorted(map(tuple, got.collect())) == [(1.0, 2.0, None), (3.0, 4.0, 5.0), (6.0, None, None)]


def test_offline_reader_strict_and_lenient(spark, tmp_path):
    head = "User_id,Merchant_id,Coupon_id,Discount_rate,Distance,Date_received,Date\n"
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text(head + "7.0,1,null,0.9,2,20160101,\n")
    bad.write_text(head + "x7,1,2,0.9,far,20160101,20169901\n8,1,2,0.9,1,20160101,null\n")
    assert FL.read_offline_csv(spark, str(good), strict=True).first().user_id == 7
    assert sorted(r.user_id or 0 for r in FL.read_offline_csv(spark, str(bad)).collect()) == [0, 8]
    assert {r.column_name: r.n_bad for r in FL.bad_values(spark, str(bad)).collect()} == {
        "User_id": 1, "Distance": 1, "Date": 1}
    with pytest.raises(ValueError, match="User_id 1, such as 'x7'"):
        FL.read_offline_csv(spark, str(bad), strict=True)


def test_published_rounds_are_the_default():
    for f in (MD.fit, J.coupon_model_job):
        assert inspect.signature(f).parameters["rounds"].default is None
    assert (MD.MAIN_PARAMS.rounds, MD.COMPACT_PARAMS.rounds, MD.USER_BLOCK_PARAMS.rounds) == (3000, 5, 10)
    assert "gbt_predictions" not in catalog.QUERIES


def test_datasets_follow_their_input(spark, tmp_path):
    """Two inputs in one session, and replaced files under one path."""
    from promo_engine.operators import clean as CL

    def rows(n):
        return [(1, k % 3, k, "0.9", 1, dt.date(2016, 5, 20), None) for k in range(n)] + [
            (1, 1, 5, "0.9", 1, dt.date(2016, 3, 10), dt.date(2016, 3, 12))]
    schema = ("user_id bigint, merchant_id bigint, coupon_id bigint, discount_rate_raw string, distance_raw bigint, "
              "date_received date, date_used date")

    def most(raw):
        clean = CL.labelled(raw)
        return J.build_datasets(spark, clean, clean)["train"].agg(F.max("consume")).first()[0]
    assert most(spark.createDataFrame(rows(2), schema)) == 2
    assert most(spark.createDataFrame(rows(14), schema)) == 14
    path = str(tmp_path / "in")
    for n in (2, 14):
        spark.createDataFrame(rows(n), schema).write.mode("overwrite").parquet(path)
        assert most(spark.read.parquet(path)) == n
