"""CSV sinks (K1, K2).  Written by the executors in parallel, one file per
partition; nothing goes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """K1 (no header, e.g. the scored submission) / K2 (with header)."""
    df.write.mode(mode).option("header", header).csv(path)


def offline_text(df: DataFrame) -> DataFrame:
    """Raw coupon rows as the text columns of an offline log."""
    day = lambda c: F.date_format(c, "yyyyMMdd")
    return df.select(F.col("user_id").cast("string").alias("User_id"), F.col("merchant_id").cast("string").alias("Merchant_id"),
                     F.col("coupon_id").cast("string").alias("Coupon_id"), F.col("discount_rate_raw").alias("Discount_rate"),
                     F.col("distance_raw").cast("string").alias("Distance"), day("date_received").alias("Date_received"),
                     day("date_used").alias("Date"))


def write_offline_csv(text: DataFrame, path: str, mode: str = "overwrite") -> None:
    """An offline log (``offline_text``) with header; missing values are ``null``."""
    text.write.mode(mode).option("header", True).option("nullValue", "null").csv(path)


def write_whitespace(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3's counterpart: a line of text per row, values apart by blanks (a null is ``-``)."""
    df.select(F.concat_ws("  ", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in df.columns]).alias("value")) \
        .write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Columnar sink for intermediate tables (e.g. cleaned coupons by month)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
