"""Dataset assembly -- feature blocks side by side on the label rows,
ids and raw columns dropped, label last, casts, full-row de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.operators import features as FT
from promo_engine.operators import user_block as UB

ID_COLUMNS = ("user_id", "coupon_id", "date_received")
DROPPED = ("merchant_id", "discount_rate_raw", "date_used")
BASE_COLUMNS = ("user_id", "coupon_id", "date_received", "distance", "is_manjian",
                "discount_rate", "min_cost_of_manjian", "null_distance")


def _finish(df: DataFrame, feature_cols: list[str], has_label: bool, drop_nulls: bool = False) -> DataFrame:
    cols = [F.col(c) for c in BASE_COLUMNS] + [F.col(f"`{c}`") for c in feature_cols]
    if has_label:
        cols.append(F.col("label").cast("int"))
    out = df.select(*cols)
    if drop_nulls:
        out = out.dropna("any")
    # Full-row de-duplication: a hash aggregate on all columns with partial
    # (map-side) aggregation, so a large group of identical rows is collapsed
    # before the shuffle.
    return out.dropDuplicates()


def assemble_main(label: DataFrame, history: DataFrame) -> DataFrame:
    """Main pipeline dataset.

    The 0-based calendar block comes first and wins for the shared names
    (``week``, ``is_weekend``, ``week_1..6``), so of the ISO one-hot block
    only ``week_7`` (Sunday) is kept, followed by ``isnull_Distance``.
    """
    has_label = "label" in label.columns
    feats = FT.label_field_features(label, history, "main", weekday_base=1)
    iso_shared = ["week", "is_weekend"] + [f"week_{i}" for i in range(1, 7)]
    kept = feats.drop(*iso_shared).withColumnRenamed("week_7", "__w7")
    cal = FT.with_calendar(kept, 0).withColumnRenamed("__w7", "week_7")
    feature_cols = (["week", "is_weekend"] + [f"week_{i}" for i in range(7)]
                    + FT.MAIN_ORDER + ["week_7", "isnull_Distance"])
    return _finish(cal, feature_cols, has_label)


def assemble_compact(label: DataFrame, history: DataFrame) -> DataFrame:
    """The compact variant's dataset: its feature subset plus the ISO calendar
    block (``week`` 1..7, ``is_weekend`` on 5/6, ``week_1..7``)."""
    has_label = "label" in label.columns
    feats = FT.label_field_features(label, history, "compact", weekday_base=1)
    feature_cols = (FT.COMPACT_ORDER + ["week", "is_weekend"] + [f"week_{i}" for i in range(1, 8)]
                    + ["isnull_Distance"])
    return _finish(feats, feature_cols, has_label)


def assemble_user_block(label: DataFrame, history: DataFrame | None = None,
                        source: str = "label") -> DataFrame:
    """Per-user-block dataset: simple counts, per-user block, 0-based calendar; rows
    with any null are dropped before de-duplication."""
    has_label = "label" in label.columns
    lab = label.withColumn("coupon_id", F.coalesce("coupon_id", F.lit(0).cast("bigint")))
    simple = UB.simple_features(lab)
    block = UB.user_block(simple, history, source)
    cal = FT.with_calendar(block, 0)
    feature_cols = ([s.name for s in UB.SIMPLE_SPECS]
                    + [UB.USER_PREFIX + c for c in UB.USER_COLUMNS]
                    + ["week", "is_weekend"] + [f"week_{i}" for i in range(7)])
    return _finish(cal, feature_cols, has_label, drop_nulls=True)


def train_union(*datasets: DataFrame) -> DataFrame:
    """Stack train and validation sets by column name."""
    out = datasets[0]
    for d in datasets[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
