"""Cleaning and labelling of raw coupon rows (narrow transformations only:
one ``select`` each, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.functions import coupon as C

CLEAN_COLUMNS = ("user_id", "merchant_id", "coupon_id", "discount_rate_raw", "distance",
                 "is_manjian", "discount_rate", "min_cost_of_manjian", "null_distance",
                 "date_received", "date_used")


def clean(raw: DataFrame) -> DataFrame:
    """Pre-processing of raw coupon rows.

    Adds the threshold flag, the discount as a rate, the threshold amount
    (-1 for plain rates), the -1-filled distance with its null flag.  A frame
    without ``date_used`` (a test file) gets an all-null one, so downstream
    code has a single schema.
    """
    date_used = (F.col("date_used") if "date_used" in raw.columns
                 else F.lit(None).cast("date"))
    dist = C.distance_filled("distance_raw")
    return raw.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("merchant_id").cast("bigint").alias("merchant_id"),
        F.col("coupon_id").cast("bigint").alias("coupon_id"),
        F.col("discount_rate_raw").cast("string").alias("discount_rate_raw"),
        dist.alias("distance"),
        C.is_threshold("discount_rate_raw").alias("is_manjian"),
        C.discount_rate("discount_rate_raw").alias("discount_rate"),
        C.min_cost("discount_rate_raw").alias("min_cost_of_manjian"),
        C.null_flag(dist).alias("null_distance"),
        F.col("date_received").cast("date").alias("date_received"),
        date_used.cast("date").alias("date_used"),
    )


def with_label(cleaned: DataFrame) -> DataFrame:
    """15-day redemption label (used <= 15 days after receipt -> 1)."""
    return cleaned.withColumn("label", C.label_15d("date_used", "date_received"))


def labelled(raw: DataFrame) -> DataFrame:
    return with_label(clean(raw))


def report_clean(raw: DataFrame) -> DataFrame:
    """The cleaned export of the exploratory notebooks.

    Distance -1-filled, the discount replaced by its rate rounded half-even to
    5 digits, threshold flag, the "cheap discount" label (rate <= 0.8), ISO
    weekday and month of receipt.
    """
    rate = C.discount_rate_rounded("discount_rate_raw")
    return raw.select(
        "user_id", "merchant_id", "coupon_id",
        rate.alias("discount_rate"),
        C.distance_filled("distance_raw").alias("distance"),
        F.col("date_received").cast("date").alias("date_received"),
        C.is_threshold("discount_rate_raw").alias("is_manjian"),
        C.cheap_label(rate).alias("cheap_label"),
        C.iso_weekday("date_received").alias("weekday_receive"),
        F.month("date_received").alias("received_month"),
    )
