"""Readers, sinks and the streaming stage."""

import os

from pyspark.sql import functions as F

from promo_engine.operators import clean as CL
from promo_engine.sources import files as FL
from promo_engine.sources.coupons import coupon_raw
from promo_engine.sources.sinks import write_csv, write_parquet
from promo_engine.streaming import coupon_stream as ST


def test_whitespace_and_registry(spark, tmp_path):
    p = tmp_path / "seeds.txt"
    p.write_text("15.26  14.84\t0.871\n 14.88 14.57  0.8811\n\n")
    df = FL.read_whitespace_text(spark, str(p))
    assert df.columns == ["_c0", "_c1", "_c2"] and df.count() == 2
    ab = tmp_path / "abalone.data"
    ab.write_text("M,0.455,0.365\nF,0.53,0.42\nI,0.44,0.365\n")
    pts = FL.load_dataset(spark, "abalone", str(ab))
    assert sorted(r.p[0] for r in pts.collect()) == [0.0, 1.0, 2.0]
    ir = tmp_path / "iris.data"
    ir.write_text("5.1,3.5,1.4,0.2,Iris-setosa\n4.9,3.0,1.4,0.2,Iris-setosa\n")
    assert len(FL.load_dataset(spark, "iris", str(ir)).first().p) == 4
    wh = tmp_path / "wholesale.csv"
    wh.write_text("Channel,Region,Fresh,Milk\n2,3,12669,9656\n")
    assert FL.load_dataset(spark, "wholesale", str(wh)).first().p == [12669.0, 9656.0]


def test_csv_round_trip(spark, tmp_path, sf):
    d = CL.report_clean(coupon_raw(spark, sf)).select("user_id", "distance", "discount_rate")
    out = str(tmp_path / "out")
    write_csv(d, out, header=True)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == d.count()
    write_parquet(d, str(tmp_path / "pq"), ["distance"])
    assert spark.read.parquet(str(tmp_path / "pq")).count() == d.count()


def test_streaming_matches_batch(spark, tmp_path, sf):
    src = str(tmp_path / "src")
    raw = coupon_raw(spark, sf)
    raw.repartition(3).write.parquet(src)
    q = ST.write_stream(ST.labelled_stream(spark, src, max_files_per_trigger=1),
                        str(tmp_path / "sink"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "sink"))
    exp = CL.labelled(raw)
    assert got.count() == exp.count()
    assert got.agg(F.sum("label")).first()[0] == exp.agg(F.sum("label")).first()[0]
    q2 = ST.write_stream(ST.daily_received_stream(spark, src, watermark="0 days"),
                         str(tmp_path / "days"), str(tmp_path / "ck2"))
    q2.awaitTermination(120)
    days = spark.read.parquet(str(tmp_path / "days"))
    # append mode emits a day once the watermark passes it: every day but the last
    batch = raw.where(F.col("date_received").isNotNull()).groupBy("date_received").agg(
        F.count("coupon_id").alias("n_received"))
    assert days.exceptAll(batch).count() == 0
    assert days.count() >= batch.count() - 1
    assert os.path.isdir(str(tmp_path / "ck"))
