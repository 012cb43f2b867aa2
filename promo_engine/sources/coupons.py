"""Coupon log source.

The canonical raw coupon schema used by every operator::

    user_id bigint, merchant_id bigint, coupon_id bigint (null: bought without
    coupon), discount_rate_raw string ("0.95" or "150:20"), distance_raw bigint
    (null: unknown), date_received date, date_used date (null: never used)

Two producers exist: the offline CSV logs (``sources.files.read_offline_csv``)
and the adapter below, which derives coupon rows from the driver's
``lineitem`` / ``orders`` tables so the pipeline can run on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promo_engine.sources.tables import read_table

RAW_COLUMNS = ("user_id", "merchant_id", "coupon_id", "discount_rate_raw",
               "distance_raw", "date_received", "date_used")


def coupon_raw(spark: SparkSession, sf_dir: str, received_range=None) -> DataFrame:
    """Coupon rows derived from lineitem x orders (one row per line item).

    Plan shape: two pruned parquet scans (8 + 3 columns) and one equi-join on
    the order key.  At scale both sides are large, so this is a sort-merge
    join on ``l_orderkey``; the order key is near-unique on ``orders`` and has
    at most 7 line items, so it cannot skew.

    ``received_range=(lo, hi)`` keeps only rows received in [lo, hi) (dates).
    The receipt date is the order date when a coupon exists, so the range
    becomes plain column filters on both scans (pushed into parquet) instead
    of a filter on a derived column above the join.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_tax", "l_returnflag", "l_linestatus")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if received_range is not None:
        lo, hi = received_range
        li = li.where(F.col("l_tax") != 0)
        od = od.where((F.col("o_orderdate") >= F.lit(_midnight(lo)))
                      & (F.col("o_orderdate") < F.lit(_midnight(hi))))
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")

    no_coupon = F.col("l_tax") == 0
    day = F.col("o_orderdate").cast("date")
    threshold_text = F.concat(((F.col("l_partkey") % 10 + 1) * 10).cast("string"), F.lit(":"),
                              (F.col("l_suppkey") % 9 + 1).cast("string"))
    rate_text = F.concat(F.lit("0."), (F.lit(50) + F.col("l_partkey") % 50).cast("string"))
    return j.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.when(~no_coupon, F.col("l_partkey") % 200).alias("coupon_id"),
        F.when(no_coupon, F.lit(None).cast("string"))
         .when(F.col("l_linestatus") == "F", threshold_text)
         .otherwise(rate_text).alias("discount_rate_raw"),
        F.when(F.col("l_linenumber") != 7, F.col("l_partkey") % 11).alias("distance_raw"),
        F.when(~no_coupon, day).alias("date_received"),
        F.when(no_coupon | (F.col("l_returnflag") != "A"),
               F.date_add(day, F.col("l_quantity").cast("int"))).alias("date_used"),
    )


def _midnight(d):
    import datetime as dt
    return dt.datetime(d.year, d.month, d.day)


# The adapter as SQL text: runs unchanged in Spark SQL and DuckDB.  The oracle
# queries are written on top of it.
COUPON_RAW_SQL = """select o_custkey as user_id,
       l_suppkey as merchant_id,
       case when l_tax = 0 then null else l_partkey % 200 end as coupon_id,
       case when l_tax = 0 then null
            when l_linestatus = 'F'
              then concat(cast((l_partkey % 10 + 1) * 10 as varchar(10)), ':', cast(l_suppkey % 9 + 1 as varchar(10)))
            else concat('0.', cast(50 + l_partkey % 50 as varchar(10))) end as discount_rate_raw,
       case when l_linenumber = 7 then null else l_partkey % 11 end as distance_raw,
       case when l_tax = 0 then null else cast(o_orderdate as date) end as date_received,
       case when l_tax = 0 or l_returnflag <> 'A'
              then cast(o_orderdate as date) + cast(l_quantity as int) end as date_used
from lineitem join orders on l_orderkey = o_orderkey"""
