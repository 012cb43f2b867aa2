"""Hand-made edge rows (FIXTURES section 4) through the offline CSV reader,
cleaning, labelling and the report export."""

import datetime as dt

import pytest

from promo_engine.operators import clean as CL
from promo_engine.sources.files import read_offline_csv

CSV = """User_id,Merchant_id,Coupon_id,Discount_rate,Distance,Date_received,Date
1,1,10,150:20,1,20160516,20160531
2,1,11,0.9,null,20160516,20160601
3,1,12,0.8,0,20160516,20160510
4,1,13,10:1,10,20160521,null
5,1,null,null,2,null,20160520
6,1,14,0.5,3,20160602,null
6,1,14,0.5,3,20160602,null
7,1,15,64:63,4,20160603,null
8,1,16,0.7,5,20160604,null
"""


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("csv") / "offline.csv"
    p.write_text(CSV)
    raw = read_offline_csv(spark, str(p))
    lab = {r["user_id"]: r for r in CL.labelled(raw).collect()}
    rep = {r["user_id"]: r for r in CL.report_clean(raw).collect()}
    return lab, rep, raw


def test_threshold_coupon(rows):
    lab, _, _ = rows
    r = lab[1]
    assert r.is_manjian == 1 and r.min_cost_of_manjian == 150
    assert r.discount_rate == pytest.approx(130 / 150)
    assert r.label == 1 and (r.date_used - r.date_received).days == 15


def test_one_day_late_and_null_distance(rows):
    lab, _, _ = rows
    r = lab[2]
    assert (r.is_manjian, r.discount_rate, r.min_cost_of_manjian) == (0, 0.9, -1)
    assert (r.distance, r.null_distance, r.label) == (-1, 1, 0)


def test_used_before_receipt_counts(rows):
    lab, rep, _ = rows
    assert lab[3].label == 1
    assert rep[3].cheap_label == 1


def test_never_used_weekday(rows):
    lab, rep, _ = rows
    assert lab[4].label == 0
    assert rep[4].weekday_receive == 6  # Saturday, ISO


def test_no_coupon(rows):
    lab, _, _ = rows
    r = lab[5]
    assert r.coupon_id is None and r.discount_rate is None
    assert (r.is_manjian, r.min_cost_of_manjian, r.label) == (0, -1, 0)
    assert r.date_received is None and r.date_used == dt.date(2016, 5, 20)


def test_half_even_rounding(rows):
    _, rep, _ = rows
    assert rep[7].discount_rate == 0.01562


def test_raw_schema(rows):
    _, _, raw = rows
    assert raw.columns == ["user_id", "merchant_id", "coupon_id", "discount_rate_raw",
                           "distance_raw", "date_received", "date_used"]
