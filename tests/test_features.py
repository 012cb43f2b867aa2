"""Feature blocks: edge semantics, two formulations agree, invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from promo_engine.operators import clean as CL
from promo_engine.operators import dataset as DS
from promo_engine.operators import features as FT
from promo_engine.operators import user_block as UB
from promo_engine.plans import catalog as K
from promo_engine.sources.coupons import RAW_COLUMNS

SCHEMA = ("user_id bigint, merchant_id bigint, coupon_id bigint, discount_rate_raw string, "
          "distance_raw bigint, date_received date, date_used date")
D = dt.date


def _frame(spark, rows):
    return CL.labelled(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture(scope="module")
def small(spark):
    history = _frame(spark, [
        (1, 1, 10, "150:20", 1, D(2016, 3, 5), D(2016, 3, 10)),
        (1, 2, 11, "0.9", None, D(2016, 3, 6), None),
        (2, 1, 12, "0.8", 4, D(2016, 3, 7), D(2016, 3, 30)),
    ])
    label = _frame(spark, [
        (1, 1, 14, "0.5", 3, D(2016, 6, 2), None),
        (1, 1, 14, "0.5", 3, D(2016, 6, 2), None),
        (6, 1, 15, "64:63", 4, D(2016, 6, 3), None),
        (8, 3, 16, "0.7", 5, D(2016, 6, 4), None),
    ])
    return history, label


def test_repeat_and_first_last(spark, small):
    history, label = small
    f = FT.label_field_features(label, history, "main")
    rows = {(r.user_id, r.coupon_id): r for r in f.collect()}
    r = rows[(1, 14)]
    assert r.User_if_same_Date_received_special_Coupon == 1
    assert r.User_Date_received_special_Coupon == 2
    r8 = rows[(8, 16)]
    assert r8.if_first_time == 1 and r8.if_last_time == 1


def test_user_absent_from_history_is_null(spark, small):
    history, label = small
    f = FT.label_field_features(label, history, "main")
    r = [x for x in f.collect() if x.user_id == 8][0]
    for name in ["min_distance_x", "max_distance_x", "mean_distance", "receive_buy_median_distance",
                 "receive_buy_mean_rate", "get_consume", "receive_use_mean", "receive_use_median",
                 "receive_use_max", "receive_use_min", "receive_cnt_y", "differ_coupon_cnt",
                 "min_discount_rate", "max_discount_rate", "max_distance_y"]:
        assert r[name] is None, name
    # label-field counts exist
    assert r.consume == 1


def test_history_values(spark, small):
    history, label = small
    f = FT.label_field_features(label, history, "main")
    r = [x for x in f.collect() if x.user_id == 1][0]
    # user 1 history: one used row (distance 1, gap received-used = -5), one unused (distance -1)
    assert r.get_consume == 1 and r.receive_use_max == -5 and r.receive_use_mean == -5.0
    assert r.min_distance_x == 1 and r.receive_cnt_y == 2
    assert r.differ_coupon_cnt == 2
    # no threshold coupon in the label field: count is null, so is the ratio
    assert r.manjian_coupon is None and r.User_manjian_rate is None


def test_two_formulations_agree(spark, sf):
    history, label = K.fields(spark, sf)
    lab = FT.prepare_label_field(label)
    specs = FT.specs_for(FT.MAIN_ORDER)
    a = FT.attach(lab, history, specs, chained=True)
    b = FT.attach(lab, history, specs, chained=False)
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_invariants(spark, sf):
    history, label = K.fields(spark, sf)
    n = label.count()
    f = FT.label_field_features(label, history, "main")
    assert f.count() == n  # left joins keep every label row
    bad = f.where((F.col("User_Date_received_x") != F.col("User_Date_received_y"))
                  | (F.col("User_Date_received_special_Coupon") != F.col("User_Date_received_coupon")))
    assert bad.count() == 0
    # history and label intervals are disjoint
    assert history.join(label, ["date_received"]).count() == 0


def test_dataset_columns(spark, sf):
    history, label = K.fields(spark, sf)
    d = DS.assemble_main(label, history)
    assert d.columns[-1] == "label"
    assert "week_0" in d.columns and "week_7" in d.columns and "week_1" in d.columns
    assert "merchant_id" not in d.columns and "date_used" not in d.columns
    assert d.count() == d.distinct().count()


def test_user_block_fills_zero(spark, small):
    history, label = small
    out = UB.user_block(label, history, source="history")
    r = [x for x in out.collect() if x.user_id == 8][0]
    assert r["history_field_User_id_receive_cnt"] == 0
    assert r["history_field_User_id_receive_and rate"] == 0.0


def test_raw_columns_constant():
    assert RAW_COLUMNS[0] == "user_id"


def test_widest_chain_is_joined_last(spark, monkeypatch):
    """Joins shuffle what was attached before; the columns come in the order of the specs' key sets all the same."""
    import datetime as dt

    from promo_engine.operators import features as FT
    day = dt.date(2016, 1, 1)
    rows = [(1, 7, 3, "0.9", 2, day, day, 0, 0.9, 1), (1, 8, 3, "0.9", 2, day, None, 0, 0.9, 0),
            (2, 7, None, None, None, None, day, 0, None, 0)]
    lab = spark.createDataFrame(rows, "user_id long, merchant_id long, coupon_id long, discount_rate_raw string, distance long, "
                                      "date_received date, date_used date, is_manjian int, discount_rate double, label int")
    widths, join = [], FT._join_keys

    def spied(left, right, keys, *more):
        if "discount_rate_raw" in left.columns:
            widths.append(len(right.columns) - len(keys))
        return join(left, right, keys, *more)
    monkeypatch.setattr(FT, "_join_keys", spied)
    got = FT.attach(lab, lab, FT.MAIN_SPECS)
    assert len(widths) > 2 and widths == sorted(widths)
    plain = FT.attach(lab, lab, FT.MAIN_SPECS, chained=False).select(got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
