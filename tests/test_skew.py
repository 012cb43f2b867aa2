"""Hot keys: one user holds a third of the label rows.  With broadcasts off
and AQE's skew thresholds lowered, the label-side partition of that user is
split across tasks; results must not change."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from promo_engine.operators import clean as CL
from promo_engine.operators import features as FT

SCHEMA = ("user_id bigint, merchant_id bigint, coupon_id bigint, discount_rate_raw string, "
          "distance_raw bigint, date_received date, date_used date")


@pytest.fixture()
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows(n_users=300, hot_share=0.34, n=3000):
    base = dt.date(2016, 5, 16)
    out = []
    for i in range(n):
        user = 0 if i < int(n * hot_share) else 1 + i % n_users
        day = base + dt.timedelta(days=i % 30)
        used = day + dt.timedelta(days=i % 20) if i % 3 else None
        out.append((user, i % 17, i % 50, "150:20" if i % 4 == 0 else "0.9", i % 11, day, used))
    return out


def test_hot_user_results_unchanged(spark, skew_conf):
    rows = _rows()
    label = CL.labelled(spark.createDataFrame(rows, SCHEMA)).repartition(8)
    hist_rows = [(u, m, c, r, d, day - dt.timedelta(days=60), None if used is None else used - dt.timedelta(days=60))
                 for (u, m, c, r, d, day, used) in rows]
    history = CL.labelled(spark.createDataFrame(hist_rows, SCHEMA)).repartition(8)
    lab = FT.prepare_label_field(label)
    specs = FT.specs_for(FT.MAIN_ORDER)
    chained = FT.attach(lab, history, specs, chained=True, write_chains=True)
    direct = FT.attach(lab, history, specs, chained=False)
    cols = sorted(chained.columns)
    a, b = chained.select(cols), direct.select(cols)
    assert a.count() == len(rows)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hot = a.where(F.col("user_id") == 0).select("consume").distinct().collect()
    assert [r.consume for r in hot] == [int(len(rows) * 0.34)]
    # the hot partition was split by AQE (sort-merge join marked skew=true)
    chained.collect()
    final = chained._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final
    assert "skew=true" in final
