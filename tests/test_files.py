"""Quarantine reads, and what is written comes back."""

import datetime as dt

import pyarrow.parquet as pq

from promo_engine.plans import catalog as K
from promo_engine.plans import materialize as MZ
from promo_engine.sources import files as FL
from promo_engine.sources import sinks as SK
from promo_engine.sources.coupons import RAW_COLUMNS, coupon_raw

HEAD = "User_id,Merchant_id,Coupon_id,Discount_rate,Distance,Date_received,Date\n"


def test_bad_rows_stay_beside_the_good(spark, tmp_path):
    p = tmp_path / "log.csv"
    p.write_text(HEAD + "1,2,3,150:20,4,20160516,20160520\n"
                 "2,2,null,null,null,null,20160520\n"
                 "x1,2,3,0.9,far,20160516.0,2016\n"
                 "4,2\n"
                 "5,2,3,0.9,1,20160516,20160520,extra\n"
                 "6.0,2,3,0.9,1,20161301,null\n")
    rows = FL.read_quarantined(spark, str(p)).collect()
    by = {r.discount_rate_raw if r.user_id is None else r.user_id: r for r in rows}
    assert len(rows) == 6 and [r.reason for r in rows].count(None) == 2
    assert by[1].distance_raw == 4 and by[1].date_used == dt.date(2016, 5, 20) and by[1].line is None
    assert by[2].reason is None and by[2].coupon_id is None and by[2].date_received is None
    bad = by["0.9"]
    assert bad.reason == "User_id: x1; Distance: far; Date: 2016" and bad.date_received == dt.date(2016, 5, 16)
    assert by[4].reason == by[5].reason == "wrong number of fields" and by[4].line == "4,2" and by[5].line.endswith("extra")
    assert by[6].reason == "Date_received: 20161301" and by[6].merchant_id == 2
    good = FL.read_quarantined(spark, str(p)).where("reason is null").select(*RAW_COLUMNS)
    assert good.count() == 2


def test_quarantine_without_outcome_and_rows(spark, tmp_path):
    p = tmp_path / "test.csv"
    p.write_text("User_id,Merchant_id,Coupon_id,Discount_rate,Distance,Date_received\n7,1,2,0.5,null,20160701\n")
    r = FL.read_quarantined(spark, str(p)).collect()
    assert len(r) == 1 and r[0].date_used is None and r[0].reason is None
    p.write_text(HEAD)
    assert FL.read_quarantined(spark, str(p)).count() == 0


def test_offline_log_round_trip(spark, tmp_path, sf):
    raw = coupon_raw(spark, sf)
    SK.write_offline_csv(SK.offline_text(raw), str(tmp_path / "log"))
    back = FL.read_offline_csv(spark, str(tmp_path / "log"), strict=True)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_planted_values_are_counted(spark, sf):
    out = K.q_csv_round_trip(spark, sf)
    raw = coupon_raw(spark, sf)
    assert out.count() == raw.count()
    assert out.where("reason like '%Distance: far%'").count() == raw.where("user_id % 97 = 0").count()
    assert out.where("reason like '%Date: 20161345%'").count() == raw.where("merchant_id % 13 = 0 and date_used is not null").count() > 0


def test_written_fields_need_no_plan(spark, sf, tmp_path):
    """A second call neither builds the source nor writes; a replaced file does both."""
    import shutil
    for t in ("lineitem", "orders"):
        shutil.copyfile(f"{sf}/{t}.parquet", tmp_path / f"{t}.parquet")
    d, calls = str(tmp_path), []

    def source():
        calls.append(1)
        return K.labelled(spark, d, MZ.received_range(K.SP.ADAPTER_SPLITS))
    how = {"token": "once", "family": K.SP.ADAPTER_SPLITS, "sources": [f"{d}/{t}.parquet" for t in ("lineitem", "orders")]}
    first = [x.count() for x in MZ.fields(spark, source, K.TRAIN, **how)]
    assert [x.count() for x in MZ.fields(spark, source, K.VALIDATE, **how)] and len(calls) == 1
    half = pq.read_table(f"{sf}/lineitem.parquet")
    pq.write_table(half.slice(0, half.num_rows // 2), tmp_path / "lineitem.parquet")
    fewer = [x.count() for x in MZ.fields(spark, source, K.TRAIN, **how)]
    assert len(calls) == 2 and all(a < b for a, b in zip(fewer, first))
