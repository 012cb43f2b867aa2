"""Feature compiler internals: chain assignment, distinct counts, null keys."""

import datetime as dt

from pyspark.sql import functions as F

from promo_engine.operators import features as FT
from promo_engine.operators import user_block as UB

SCHEMA = ("user_id bigint, merchant_id bigint, coupon_id bigint, discount_rate_raw string, "
          "distance int, is_manjian int, discount_rate double, date_received date, date_used date, label int")
D = dt.date(2016, 5, 20)


def test_chains_cover_every_key_set():
    blocks = FT.group_blocks(FT.MAIN_SPECS)
    ch = FT.chains(blocks)
    tops = [t for t, _ in ch]
    assert len(ch) == 4
    seen = [k for _, members in ch for k, _ in members]
    assert sorted(seen) == sorted(k for k, _ in blocks)
    for top, members in ch:
        assert all(set(k) <= set(top) for k, _ in members)
    assert ("discount_rate",) in tops


def test_distinct_counts_and_null_keys(spark):
    rows = [
        (1, 10, 5, "0.9", 1, 0, 0.9, D, None, 0),
        (1, 10, 6, "0.9", -1, 0, 0.9, D, None, 0),
        (1, 11, 7, "0.9", 2, 0, 0.9, D, None, 0),
        (None, 12, 8, "0.9", 3, 0, 0.9, D, None, 0),
        (None, 13, 8, "0.9", -1, 0, 0.9, D, None, 0),
    ]
    label = spark.createDataFrame(rows, SCHEMA)
    specs = [FT.Spec("n_merchants", "L", ("user_id",), "ndistinct", "merchant_id"),
             FT.Spec("n_known", "L", ("user_id",), "ndistinct", "merchant_id", "known_distance"),
             FT.Spec("n_rows", "L", ("user_id",), "count")]
    t = {r.user_id: r for r in FT.aggregate_block(label, None, ("user_id",), specs).collect()}
    assert (t[1].n_merchants, t[1].n_known, t[1].n_rows) == (2, 2, 3)
    # a null user forms no group (the pipeline's group-by drops null keys) ...
    assert None not in t
    out = FT.attach(label, None, specs)
    got = sorted((r.user_id is None, r.n_merchants) for r in out.collect())
    # ... so those rows get null features
    assert got == [(False, 2)] * 3 + [(True, None)] * 2


def test_null_receipt_date_is_a_group(spark):
    rows = [(1, 10, 5, "0.9", 1, 0, 0.9, None, None, 0),
            (1, 11, 5, "0.9", 1, 0, 0.9, None, None, 0),
            (1, 12, 5, "0.9", 1, 0, 0.9, D, None, 0)]
    label = spark.createDataFrame(rows, SCHEMA)
    specs = [FT.Spec("per_day", "L", ("user_id", "date_received"), "count")]
    got = sorted((r.date_received is None, r.per_day) for r in FT.attach(label, None, specs).collect())
    assert got == [(False, 1), (True, 2), (True, 2)]


def test_history_null_keys_never_match(spark):
    lab = spark.createDataFrame([(1, 10, 5, "0.9", 1, 0, 0.9, D, None, 0)], SCHEMA)
    hist = spark.createDataFrame([(None, 10, 5, "0.9", 1, 0, 0.9, D, D, 1),
                                  (1, 10, 5, "0.9", 1, 0, 0.9, D, D, 1)], SCHEMA)
    specs = [FT.Spec("h_used", "H", ("user_id",), "count", None, "used")]
    agg = FT.aggregate_block(lab, hist, ("user_id",), specs)
    assert agg.where(F.col("user_id").isNull()).count() == 0
    assert FT.attach(lab, hist, specs).first().h_used == 1


def test_full_null_safe_join(spark):
    a = spark.createDataFrame([(1, "x"), (None, "n")], "k bigint, a string")
    b = spark.createDataFrame([(None, "m"), (2, "y")], "k bigint, b string")
    j = sorted((tuple(r) for r in FT._join_keys(a, b, ("k",), ("k",), "full").collect()), key=str)
    assert j == sorted([(1, "x", None), (None, "n", "m"), (2, None, "y")], key=str)


def test_distinct_merchants_per_user_expand_no_row(spark):
    rows = spark.sql("""SELECT * FROM VALUES (1, 10, date'2016-01-02', 0.9D, 1), (1, 10, null, 0.9D, 1), (1, 11, null, 0.8D, 2),
        (2, null, null, 0.9D, -1), (null, 10, date'2016-01-02', 0.9D, 1)
        AS t(user_id, merchant_id, date_used, discount_rate, distance)""")
    agg = UB.user_aggregates(rows)
    p = UB.USER_PREFIX
    got = sorted(tuple(r) for r in agg.select("user_id", p + "receive_cnt", p + "receive_differ_Merchant_cnt",
                                              p + "receive_and_consume_differ_Merchant_cnt").collect())
    assert got == [(1, 3, 2, 1), (2, 1, 0, 0)]
    assert "Expand" not in agg._jdf.queryExecution().optimizedPlan().toString()
