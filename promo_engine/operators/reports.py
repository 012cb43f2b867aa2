"""Report aggregates (chart data of the exploratory notebooks).

Each report is one grouped aggregate over the cleaned export (``report_clean``)
with partial (map-side) aggregation; the outputs are bounded by the number of
days, distances, rates or columns, never by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_received(rep: DataFrame) -> DataFrame:
    """Coupons received per day, with a flag on the busiest day(s).

    The flag uses a window over the aggregated table only (one row per day),
    so its single partition is bounded by the number of distinct days.
    """
    per_day = (rep.where(F.col("date_received").isNotNull())
               .groupBy("date_received")
               .agg(F.count("coupon_id").alias("n_received")))
    top = F.max("n_received").over(Window.partitionBy(F.lit(1)))
    return per_day.withColumn("is_max_day", F.when(F.col("n_received") == top, 1).otherwise(0))


def distance_counts(rep: DataFrame) -> DataFrame:
    """R2: rows per known distance (sorted by distance)."""
    return (rep.where(F.col("distance") != -1).groupBy("distance")
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy("distance"))


def label_rate_by_distance(rep: DataFrame, max_distance: int = 10) -> DataFrame:
    """Share of cheap-label rows per distance 0..max_distance.

    A distance with rows but no positives gives 0.0; one with no rows gives
    null.  The 0..10 axis is a generated range left-joined to the aggregate.
    """
    spark = rep.sparkSession
    axis = spark.range(0, max_distance + 1).select(F.col("id").cast("int").alias("distance"))
    agg = (rep.where(F.col("distance").between(0, max_distance)).groupBy("distance")
           .agg(F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col("cheap_label") == 1).alias("n_positive")))
    return (axis.join(agg, "distance", "left")
            .select("distance",
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                    F.try_divide(F.col("n_positive").cast("double"),
                                 F.col("n_rows").cast("double")).alias("positive_rate")))


def received_vs_label_by_rate(rep: DataFrame) -> DataFrame:
    """Rows and cheap-label rows per (rounded) discount rate; 0 when none.
    ``rate_4dp`` is the axis label (P25: the rate printed with 4 decimals)."""
    return (rep.where(F.col("discount_rate").isNotNull()).groupBy("discount_rate")
            .agg(F.count(F.lit(1)).alias("n_received"),
                 F.count_if(F.col("cheap_label") == 1).alias("n_positive"))
            .withColumn("rate_4dp", F.format_string("%.4f", "discount_rate").cast("double")))


def weekday_counts(rep: DataFrame) -> DataFrame:
    """Received vs cheap-label rows per ISO weekday 1..7 (0 when none)."""
    spark = rep.sparkSession
    axis = spark.range(1, 8).select(F.col("id").cast("int").alias("weekday_receive"))
    agg = (rep.where(F.col("weekday_receive").isNotNull()).groupBy("weekday_receive")
           .agg(F.count(F.lit(1)).alias("n_received"),
                F.count_if(F.col("cheap_label") == 1).alias("n_positive")))
    return axis.join(agg, "weekday_receive", "left").select(
        "weekday_receive",
        F.coalesce("n_received", F.lit(0)).alias("n_received"),
        F.coalesce("n_positive", F.lit(0)).alias("n_positive"))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Normalised value counts (value, n, share).

    The total is a window over the grouped table (bounded by the number of
    distinct values), not over the rows.
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return g.withColumn("share", F.col("n").cast("double") / total.cast("double"))


def coupon_type_share(rep: DataFrame) -> DataFrame:
    """Share of plain vs threshold coupons among received coupons."""
    return value_share(rep.where(F.col("date_received").isNotNull()), "is_manjian")


def coupon_type_share_positive(rep: DataFrame) -> DataFrame:
    """Share of plain vs threshold coupons among cheap-label rows."""
    return value_share(rep.where(F.col("cheap_label") == 1), "is_manjian")


def label_share(rep: DataFrame) -> DataFrame:
    """Share of positive and negative cheap labels."""
    return value_share(rep, "cheap_label")


def null_profile(df: DataFrame) -> DataFrame:
    """R10 (A16, A17): per column, whether it has nulls and the null ratio.

    One pass: a single global aggregate of one conditional count per column
    (partial aggregation on every partition), then unpivoted to long form.
    """
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"n__{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `n__{i}`" for i, c in enumerate(cols))
    long = wide.selectExpr("__n", f"stack({len(cols)}, {stack}) as (column_name, n_null)")
    return long.select(
        "column_name",
        F.col("n_null").cast("bigint").alias("n_null"),
        F.when(F.col("n_null") > 0, 1).otherwise(0).alias("has_null"),
        (F.col("n_null").cast("double") / F.col("__n").cast("double")).alias("null_ratio"))


def column_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    """R11 (A15): per-column sums and each column's share of the grand total.

    Sums are taken in decimal(38, 9) so they do not depend on the order the
    partitions are combined in; a column that leaves that range (1e29) is
    summed as doubles.  The long table has one row per column.
    """
    def total(c):
        x = F.col(f"`{c}`").cast("double")
        return F.when(F.max(F.abs(x)) < 1e18, F.try_sum(x.try_cast("decimal(38,9)")).cast("double")).otherwise(F.sum(x))
    wide = df.agg(*[total(c).alias(f"s__{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `s__{i}`" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, total)")
    grand = F.sum("total").over(Window.partitionBy(F.lit(1)))
    return long.select("column_name", F.col("total").cast("double").alias("total"),
                       (F.col("total").cast("double") / grand.cast("double")).alias("share"))


def box_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """R12 (A18): box-plot numbers per column.

    Exact quartiles (linear interpolation) by distributed selection
    (``operators.quantiles``), then one pass for the whiskers -- the most
    extreme values within 1.5 IQR of the box -- and the outlier count,
    against a quartile table of one row per column.  NaN counts as missing,
    infinities are values; a column without values has null numbers and no
    outliers, one whose box has an infinite or undefined width no whiskers
    where no value lies inside.
    """
    from promo_engine.operators.quantiles import exact_quantiles
    long = unpivot_numeric(df, cols)
    q = exact_quantiles(long, (0.25, 0.5, 0.75))
    spark = df.sparkSession
    qt = spark.createDataFrame([(c, *q.get(c, (None, None, None))) for c in cols],
                               "column_name string, q1 double, median double, q3 double")
    qt = qt.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
           .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    inside = (F.col("value") >= F.col("lo_fence")) & (F.col("value") <= F.col("hi_fence"))
    # the rows meet the box table where they are read and are added up there; joined to them from the left, so that
    # columns without values have their row too, it can't be sent to the tasks, and all rows of a column meet in one
    per = (long.where(~F.isnan("value")).join(F.broadcast(qt), "column_name")
           .groupBy("column_name")
           .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                F.count_if(~inside).alias("n_outliers")))
    return (qt.join(F.broadcast(per), "column_name", "left")          # a row per column on both sides
            .select("column_name", "q1", "median", "q3", "whisker_low", "whisker_high",
                    F.coalesce("n_outliers", F.lit(0).cast("bigint")).alias("n_outliers")))


def unpivot_numeric(df: DataFrame, cols: list[str], id_cols: list[str] | None = None) -> DataFrame:
    """Wide numeric columns to long (id..., column_name, value double)."""
    ids = id_cols or []
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    return df.selectExpr(*[f"`{i}`" for i in ids],
                         f"stack({len(cols)}, {stack}) as (column_name, value)")
