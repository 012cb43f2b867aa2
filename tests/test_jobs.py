"""End-to-end jobs on inputs in the original file formats."""

from pyspark.sql import functions as F

from promo_engine.plans import jobs as J
from promo_engine.sources.coupons import coupon_raw
from promo_engine.sources.tables import read_table


def _write_offline(spark, sf, path, with_date=True):
    raw = coupon_raw(spark, sf)
    # spread the receipt days over the first half of 2016 (keeps the gaps)
    shift = F.datediff("date_received", F.lit("1995-01-01").cast("date")) % 180
    base = F.lit("2016-01-01").cast("date")
    rec = F.date_add(base, shift)
    used = F.date_add(rec, F.datediff("date_used", "date_received"))
    used = F.when(F.col("date_received").isNull() & F.col("date_used").isNotNull(),
                  F.date_add(base, F.datediff("date_used", F.lit("1995-01-01").cast("date")) % 180)) \
        .otherwise(used)
    cols = [F.col("user_id").alias("User_id"), F.col("merchant_id").alias("Merchant_id"),
            F.col("coupon_id").alias("Coupon_id"), F.col("discount_rate_raw").alias("Discount_rate"),
            F.col("distance_raw").alias("Distance"),
            F.date_format(rec, "yyyyMMdd").alias("Date_received")]
    if with_date:
        cols.append(F.date_format(used, "yyyyMMdd").alias("Date"))
    raw.select(*cols).coalesce(1).write.option("header", True).option("nullValue", "null").csv(path)


def test_coupon_model_job(spark, sf, tmp_path):
    tr, te = str(tmp_path / "train"), str(tmp_path / "test")
    _write_offline(spark, sf, tr)
    _write_offline(spark, sf, te, with_date=False)
    res = J.coupon_model_job(spark, tr, te, "main", rounds=3, out_dir=str(tmp_path / "out"))
    assert res.predictions.count() > 0
    assert 0.5 <= res.train_auc <= 1.0
    assert res.importance.count() > 0
    assert spark.read.csv(str(tmp_path / "out" / "result")).count() == res.predictions.count()
    res2 = J.coupon_model_job(spark, tr, te, "compact", rounds=2)
    assert res2.predictions.count() > 0


def test_clustering_job(spark, sf, tmp_path):
    emb = read_table(spark, sf, "embeddings")
    p = str(tmp_path / "wine")
    emb.select(*[F.col("embedding")[i].cast("double").alias(f"c{i}") for i in range(8)]) \
        .coalesce(1).write.option("header", False).csv(p)
    res = J.clustering_job(spark, "wine", p, method="lloyd", ks=range(2, 5))
    assert 2 <= res.k <= 4
    assert res.scores.count() == 3
    assert res.report.agg(F.sum("n_points")).first()[0] == emb.count()


def test_report_job(spark, sf, tmp_path):
    te = str(tmp_path / "test")
    _write_offline(spark, sf, te, with_date=False)
    tables = J.report_job(spark, te, str(tmp_path / "rep"))
    assert tables["weekday_counts"].count() == 7
    assert tables["label_rate_by_distance"].count() == 11
    nulls = {r.column_name: r.has_null for r in tables["null_profile"].collect()}
    assert nulls["coupon_id"] == 1 and nulls["user_id"] == 0
