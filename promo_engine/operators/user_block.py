"""Third variant's feature blocks: simple label-field counts (T01-T05) and the per-user
block (T06-T14), plus the 0-based calendar block (T16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.functions import coupon as C
from promo_engine.operators.features import CP, DR, U, Spec, attach

SIMPLE_SPECS = [
    Spec("simple_User_id_receive_cnt", "L", (U,), "count"),
    Spec("simple_User_id_Coupon_id_receive_cnt", "L", (U, CP), "count"),
    Spec("simple_User_id_Date_received_receive_cnt", "L", (U, DR), "count"),
    Spec("simple_User_id_Coupon_id_Date_received_receive_cnt", "L", (U, CP, DR), "count"),
    Spec("simple_User_id_Coupon_id_Date_received_repeat_receive", "L", (U, CP, DR), "repeat"),
]

USER_PREFIX = "history_field_User_id_"


def simple_features(label: DataFrame) -> DataFrame:
    """Receipt counts of the label field per user / coupon / day."""
    return attach(label, None, SIMPLE_SPECS)


def user_aggregates(source: DataFrame) -> DataFrame:
    """One grouped aggregate per user (partial aggregation), and the
    distinct merchants in two levels, so that no row is expanded for them.

    Follows the commented intent where the notebook's code is broken:
    merchant counts are distinct counts (not the printed length of the
    group), and "consumed" means ``date_used`` is present.  Rows without a
    user form no group.
    """
    used = F.col("date_used").isNotNull()
    p = USER_PREFIX
    source = source.where(F.col(U).isNotNull())
    merchants = (source.where(F.col("merchant_id").isNotNull())
                 .groupBy(U, "merchant_id").agg(F.max(used).alias("__used"))
                 .groupBy(U).agg(F.count(F.lit(1)).alias(p + "receive_differ_Merchant_cnt"),
                                 F.count_if("__used").alias(p + "receive_and_consume_differ_Merchant_cnt")))
    counts = source.groupBy(U).agg(
        F.count(F.lit(1)).alias(p + "receive_cnt"),
        F.count_if(used).alias(p + "receive_and_consume_cnt"),
        F.count_if(~used).alias(p + "receive_not_consume_cnt"),
        C.stable_mean(F.when(used, F.col("discount_rate"))).alias(
            p + "receive_and_consume_mean_discount_rate"),
        C.stable_mean(F.when(used & (F.col("distance") != -1), F.col("distance"))).alias(
            p + "receive_and_consume_mean_distance"),
    )
    return counts.join(merchants, U, "left").fillna(0, [c for c in merchants.columns if c != U])


USER_COLUMNS = [
    "receive_cnt", "receive_differ_Merchant_cnt", "receive_and_consume_cnt",
    "receive_not_consume_cnt", "receive_and rate", "receive_and_consume_mean_discount_rate",
    "receive_and_consume_mean_distance", "receive_and_consume_differ_Merchant_cnt",
    "receive_differ_Merchant_consume_rate",
]


def user_block(label: DataFrame, history: DataFrame | None = None, source: str = "label") -> DataFrame:
    """Attach the per-user block to the label rows.

    ``source="label"`` reproduces the notebook (it reads the label field
    itself); ``source="history"`` computes it from the history field.  Users
    with no source rows get 0 everywhere (the notebook fills nulls with 0).
    """
    src = label if source == "label" else history
    agg = user_aggregates(src)
    p = USER_PREFIX
    j = label.join(agg, U, "left")
    ratios = ("receive_and rate", "receive_differ_Merchant_consume_rate")
    means = ("receive_and_consume_mean_discount_rate", "receive_and_consume_mean_distance")
    z = {c: F.coalesce(F.col(p + c), F.lit(0.0 if c in means else 0))
         for c in USER_COLUMNS if c not in ratios}
    cols = []
    for c in USER_COLUMNS:
        if c == "receive_and rate":
            e = C.guarded_ratio(z["receive_and_consume_cnt"], z["receive_cnt"])
        elif c == "receive_differ_Merchant_consume_rate":
            e = C.guarded_ratio(z["receive_and_consume_differ_Merchant_cnt"],
                                z["receive_differ_Merchant_cnt"])
        else:
            e = z[c]
        cols.append(e.alias(p + c))
    return j.select(*[F.col(c) for c in label.columns], *cols)
