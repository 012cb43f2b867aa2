"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the coupon adapter or the
``embeddings`` / ``lineitem`` tables) in full; nothing is sampled or capped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promo_engine.functions.coupon import stable_mean
from promo_engine.operators import boost as BO
from promo_engine.operators import clean as CL
from promo_engine.operators import cluster as CU
from promo_engine.operators import dataset as DS
from promo_engine.operators import features as FT
from promo_engine.operators import model as MD
from promo_engine.operators import ranking as RK
from promo_engine.operators import reports as R
from promo_engine.operators import silhouette as SI
from promo_engine.operators import user_block as UB
from promo_engine.plans import materialize as MZ
from promo_engine.plans import split as SP
from promo_engine.session import scratch_path
from promo_engine.sources import files as FL
from promo_engine.sources import sinks as SK
from promo_engine.sources.coupons import coupon_raw
from promo_engine.sources.tables import read_table, table_path

TRAIN = SP.ADAPTER_SPLITS[0]
VALIDATE = SP.ADAPTER_SPLITS[1]
TEST = SP.ADAPTER_SPLITS[2]


# ---- shared inputs ---------------------------------------------------------
def labelled(spark: SparkSession, sf: str, received_range=None) -> DataFrame:
    return CL.labelled(coupon_raw(spark, sf, received_range))


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    return CL.report_clean(coupon_raw(spark, sf))


def fields(spark: SparkSession, sf: str, split: SP.SplitSet = TRAIN):
    """(history, label) of a split, read from the table written once per
    session for all adapter splits (one pass over the source, pruned to the
    receipt dates the splits cover)."""
    family = SP.ADAPTER_SPLITS
    return MZ.fields(spark, lambda: labelled(spark, sf, MZ.received_range(family)), split, token=f"adapter:{sf}",
                     family=family, sources=[table_path(sf, t) for t in ("lineitem", "orders")])


# ---- cleaning / label --------------------------------------------------------
def q_clean_offline(spark, sf):
    return CL.clean(coupon_raw(spark, sf))


def q_label_15d(spark, sf):
    d = labelled(spark, sf)
    return d.select("user_id", "merchant_id", "coupon_id", "date_received", "date_used",
                    F.datediff("date_used", "date_received").alias("gap_days"), "label")


def q_report_clean(spark, sf):
    return report_rows(spark, sf)


def q_null_profile(spark, sf):
    return R.null_profile(coupon_raw(spark, sf))


# ---- reports -----------------------------------------------------------------
def _rep(fn):
    return lambda spark, sf: fn(report_rows(spark, sf))


# ---- split ---------------------------------------------------------------------
def q_split_windows(spark, sf):
    """Row, user, used and label counts of every interval of the three
    adapter split sets, in one scan (rows are tagged with every interval
    they fall in, then grouped)."""
    d = labelled(spark, sf)
    tags = []
    for s in SP.ADAPTER_SPLITS:
        for field, iv in (("history", s.history), ("middle", s.middle), ("label", s.label)):
            if iv is not None:
                tags.append(F.when(iv.predicate(), F.lit(f"{s.name}/{field}")))
    t = d.select("user_id", "date_used", "label",
                 F.explode(F.array_compact(F.array(*tags))).alias("tag"))
    return (t.groupBy("tag").agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count_distinct("user_id").alias("n_users"),
                                 F.count("date_used").alias("n_used"),
                                 F.count_if(F.col("label") == 1).alias("n_label1"))
            .select(F.split_part("tag", F.lit("/"), F.lit(1)).alias("split_set"),
                    F.split_part("tag", F.lit("/"), F.lit(2)).alias("field"),
                    "n_rows", "n_users", "n_used", "n_label1"))


# ---- feature blocks ----------------------------------------------------------------
BLOCKS = {
    "feat_L_user": ("L", (FT.U,)),
    "feat_L_user_date": ("L", (FT.U, FT.DR)),
    "feat_L_user_coupon_date": ("L", (FT.U, FT.CP, FT.DR)),
    "feat_L_user_merchant": ("L", (FT.U, FT.M)),
    "feat_L_user_merchant_coupon": ("L", (FT.U, FT.M, FT.CP)),
    "feat_L_user_distance": ("L", (FT.U, FT.DIST)),
    "feat_L_merchant": ("L", (FT.M,)),
    "feat_L_merchant_coupon": ("L", (FT.M, FT.CP)),
    "feat_L_rate": ("L", (FT.RATE,)),
    "feat_H_user": ("H", (FT.U,)),
    "feat_H_merchant": ("H", (FT.M,)),
    "feat_H_coupon": ("H", (FT.CP,)),
    "feat_H_user_merchant": ("H", (FT.U, FT.M)),
}


def _block_query(src, keys):
    def q(spark, sf):
        history, label = fields(spark, sf)
        lab = FT.prepare_label_field(label)
        specs = [s for s in FT.MAIN_SPECS if s.src == src and s.keys == keys]
        t = FT.aggregate_block(lab, history, keys, specs)
        ren = {"if_first_time": "first_received", "if_last_time": "last_received"}
        return t.select(*keys, *[F.col(f"`{s.name}`").alias(ren.get(s.name, s.name)) for s in specs])
    return q


def q_feat_ratios(spark, sf):
    """Row-level ratio features (C18/C19) and the threshold cut on every
    label row, with the row's ids."""
    history, label = fields(spark, sf)
    names = [n for n, *_ in FT.MAIN_ROW_FEATURES]
    f = FT.label_field_features(label, history, "main", only=names)
    return f.select("user_id", "merchant_id", "coupon_id", "date_received", "distance",
                    *[F.col(n) for n in names])


def q_feat_calendar(spark, sf):
    """F57-F60 / T16 calendar columns of every label row (ISO and 0-based)."""
    _, label = fields(spark, sf)
    iso = FT.with_calendar(label.select("user_id", "coupon_id", "date_received", "distance"), 1)
    both = FT.with_calendar(iso.withColumnRenamed("week", "week_iso")
                            .withColumnRenamed("is_weekend", "is_weekend_iso"), 0, "wd0_")
    return both.withColumnRenamed("week", "week0").withColumnRenamed("is_weekend", "is_weekend0") \
        .withColumn("isnull_Distance", F.when(F.col("distance") == -1, 1).otherwise(0))


# ---- per-user block variant ------------------------------------------------------------------
def q_receipt_counts(spark, sf):
    _, label = fields(spark, sf)
    lab = FT.prepare_label_field(label)
    out = UB.simple_features(lab)
    return out.select("user_id", "merchant_id", "coupon_id", "date_received",
                      *[s.name for s in UB.SIMPLE_SPECS])


def q_user_block_history(spark, sf):
    """The per-user block computed from the history field instead of the
    label field (users without history rows get 0)."""
    history, label = fields(spark, sf)
    out = UB.user_block(label, history, source="history")
    return out.select("user_id", "merchant_id", "coupon_id", "date_received",
                      *[F.col(f"`{UB.USER_PREFIX + c}`") for c in UB.USER_COLUMNS])


def q_user_block_features(spark, sf):
    _, label = fields(spark, sf)
    out = UB.user_block(label)
    return out.select("user_id", "merchant_id", "coupon_id", "date_received",
                      *[F.col(f"`{UB.USER_PREFIX + c}`") for c in UB.USER_COLUMNS])


# ---- datasets ------------------------------------------------------------------------
def q_dataset_assembled(spark, sf):
    history, label = fields(spark, sf)
    return DS.assemble_main(label, history)


def q_dataset_compact(spark, sf):
    history, label = fields(spark, sf)
    return DS.assemble_compact(label, history)


def q_dataset_user_block(spark, sf):
    _, label = fields(spark, sf)
    return DS.assemble_user_block(label)


def _in_parallel(*fns):
    """Run independent DataFrame builders from separate driver threads: their
    jobs (chain-table writes) are scheduled concurrently by Spark."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(fns)) as pool:
        return [f.result() for f in [pool.submit(fn) for fn in fns]]


def _main_dataset(spark, sf, split):
    history, label = fields(spark, sf, split)
    return DS.assemble_main(label, history)


def q_train_union(spark, sf):
    fields(spark, sf, TRAIN)   # one pass writes the fields of every split
    tr, va = _in_parallel(lambda: _main_dataset(spark, sf, TRAIN),
                          lambda: _main_dataset(spark, sf, VALIDATE))
    return DS.train_union(tr, va)


QUERIES = {
    "clean_offline": q_clean_offline,
    "label_15d": q_label_15d,
    "report_clean": q_report_clean,
    "null_profile": q_null_profile,
    "daily_received": _rep(R.daily_received),
    "distance_counts": _rep(R.distance_counts),
    "label_rate_by_distance": _rep(R.label_rate_by_distance),
    "received_vs_label_by_rate": _rep(R.received_vs_label_by_rate),
    "weekday_counts": _rep(R.weekday_counts),
    "coupon_type_share": _rep(R.coupon_type_share),
    "coupon_type_share_positive": _rep(R.coupon_type_share_positive),
    "label_share": _rep(R.label_share),
    "split_windows": q_split_windows,
    **{name: _block_query(src, keys) for name, (src, keys) in BLOCKS.items()},
    "feat_ratios": q_feat_ratios,
    "feat_calendar": q_feat_calendar,
    "receipt_counts": q_receipt_counts,
    "user_block_features": q_user_block_features,
    "user_block_history": q_user_block_history,
    "dataset_assembled": q_dataset_assembled,
    "dataset_compact": q_dataset_compact,
    "dataset_user_block": q_dataset_user_block,
    "train_union": q_train_union,
}


# ---- clustering ------------------------------------------------------------------------


def _points(spark, sf):
    return CU.embedding_points(read_table(spark, sf, "embeddings"))


def q_centroid_distance(spark, sf):
    """Distance of every embedding to its class centroid."""
    d = CU.centroid_distances(_points(spark, sf), "label")
    return d.select("id", "label", F.round("euclidean", 9).alias("euclidean"), F.round("manhattan", 9).alias("manhattan"))


def _label_centres(pts):
    """Class centroids (one row per class, collected: k x d numbers)."""
    rows = CU.cluster_means(pts.withColumnRenamed("label", "cluster")).orderBy("cluster").collect()
    return [r["cluster"] for r in rows], [list(r["centre"]) for r in rows]


def q_lloyd_step(spark, sf):
    """One exact Lloyd pass over the embeddings, starting from the class
    centroids (k = number of classes, clusters named by class)."""
    pts = _points(spark, sf)
    ids, centres = _label_centres(pts)
    t = CU.lloyd_step_table(pts.select("id", "p"), centres, ids)
    return t.select("cluster", "n_points", F.transform("centre", lambda x: F.round(x, 9)).alias("centre"),
                    F.round("shift", 9).alias("shift"))


def q_silhouette_labels(spark, sf):
    """Silhouette (squared Euclidean) of the labelled classes, per class."""
    pts = _points(spark, sf).withColumnRenamed("label", "cluster")
    s = CU.silhouette_points(pts)
    return s.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_points"),
                                    F.round(stable_mean("silhouette"), 9).alias("mean_silhouette"))


def q_pca_2d(spark, sf):
    """Points on the first two principal axes, to 6 decimals."""
    return _pca_points(spark, sf).select("id", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def q_silhouette_euclidean(spark, sf):
    """Silhouette of the labelled classes in the plain distance, per class, to 9 decimals."""
    s = SI.euclidean_silhouette(_points(spark, sf).withColumnRenamed("label", "cluster"))
    return s.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_points"),
                                    F.round(F.avg("silhouette"), 9).alias("mean_silhouette"))


PCA_DIGITS = 6


def _pca_points(spark, sf):
    """The 2-D points of the clustering queries.  They lie on a grid of 1e-6:
    principal axes are known to some 12 digits only, and a grid gives every
    engine the same points to cluster."""
    at = [F.round(F.col(c), PCA_DIGITS) + F.lit(0.0) for c in "xy"]
    return CU.pca_2d(_points(spark, sf)).select("id", F.array(*at).alias("p"))


def q_kmeans_assign(spark, sf, k: int = 3):
    """MLlib k-means (k = 3, the default) on the 2-D PCA points."""
    _, out = CU.mllib_kmeans(_pca_points(spark, sf), k, seed=7)
    return out.select("id", "cluster", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def q_lloyd_kmeans(spark, sf, k: int = 3):
    """Exact Lloyd loop (threshold 1e-4 on the summed shift, 21 passes) on the
    2-D PCA points."""
    res = CU.lloyd_kmeans(_pca_points(spark, sf), k, seed=7)
    return res.assigned.select("id", "cluster", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def q_choose_k(spark, sf):
    """Silhouette of the Lloyd fits for k = 2 to 10 (to 9 decimals), and the k that is chosen."""
    t = CU.choose_k(_pca_points(spark, sf), seed=7)
    return t.select("k", F.round("silhouette", 9).alias("silhouette"), "chosen")


def q_cluster_report(spark, sf, k: int = 3):
    """Size, centre and mean silhouette of the three Lloyd clusters, to 9 decimals."""
    r = CU.cluster_report(CU.lloyd_kmeans(_pca_points(spark, sf), k, seed=7).assigned)
    return r.select("cluster", "n_points", F.round(F.col("centre")[0], 9).alias("x"), F.round(F.col("centre")[1], 9).alias("y"),
                    F.round("mean_silhouette", 9).alias("mean_silhouette"))


QUERIES.update({
    "centroid_distance": q_centroid_distance,
    "lloyd_step": q_lloyd_step,
    "silhouette_labels": q_silhouette_labels,
    "silhouette_euclidean": q_silhouette_euclidean,
    "pca_2d": q_pca_2d,
    "kmeans_assign": q_kmeans_assign,
    "lloyd_kmeans": q_lloyd_kmeans,
    "choose_k": q_choose_k,
    "cluster_report": q_cluster_report,
})


# ---- model ---------------------------------------------------------------------------------


def _main_sets(spark, sf):
    fields(spark, sf, TRAIN)
    tr, va, te = _in_parallel(*[(lambda s=s: _main_dataset(spark, sf, s)) for s in (TRAIN, VALIDATE, TEST)])
    return DS.train_union(tr, va), te


def main_model_sets(spark, sf):
    """(training rows, test rows) of the main model.  Its published 3000
    rounds are a job's work (``plans.jobs.coupon_model_job``), so no query
    registers a shortened copy of it."""
    return _main_sets(spark, sf)


# ---- table reports (R11-R13) on lineitem ------------------------------------------------
LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_column_sums(spark, sf):
    return R.column_sums(read_table(spark, sf, "lineitem"), LINE_NUMERIC)


def q_box_stats(spark, sf):
    return R.box_stats(read_table(spark, sf, "lineitem"), LINE_NUMERIC)


def q_long_series(spark, sf):
    """The numeric columns as (row id, column, value) series."""
    li = read_table(spark, sf, "lineitem")
    return R.unpivot_numeric(li, LINE_NUMERIC, ["l_orderkey", "l_linenumber"])


QUERIES.update({
    "column_sums": q_column_sums,
    "box_stats": q_box_stats,
    "long_series": q_long_series,
})


def _variant_dataset(spark, sf, split, variant):
    history, label = fields(spark, sf, split)
    if variant == "compact":
        return DS.assemble_compact(label, history)
    return DS.assemble_user_block(label)


def q_gbt_compact_predictions(spark, sf):
    """Second parameter set: compact features, ids kept as features, 5
    rounds, trained on the training split only (no validation set)."""
    fields(spark, sf, TRAIN)
    tr, te = _in_parallel(lambda: _variant_dataset(spark, sf, TRAIN, "compact"),
                          lambda: _variant_dataset(spark, sf, TEST, "compact"))
    fm = MD.fit(tr, MD.COMPACT_PARAMS, drop_ids=False)
    return MD.score(fm, te)


def q_gbt_user_block_predictions(spark, sf):
    """Third parameter set: per-user-block features, 10 rounds, trained on
    train + validation."""
    fields(spark, sf, TRAIN)
    tr, va, te = _in_parallel(*[(lambda s=s: _variant_dataset(spark, sf, s, "user_block"))
                                for s in (TRAIN, VALIDATE, TEST)])
    fm = MD.fit(DS.train_union(tr, va), MD.USER_BLOCK_PARAMS)
    return MD.score(fm, te)


def q_gbt_importance(spark, sf):
    """Split counts and gains of the per-user-block model (10 rounds)."""
    fields(spark, sf, TRAIN)
    tr, va = _in_parallel(*[(lambda s=s: _variant_dataset(spark, sf, s, "user_block")) for s in (TRAIN, VALIDATE)])
    return MD.importance(MD.fit(DS.train_union(tr, va), MD.USER_BLOCK_PARAMS))


def q_gbt_watch(spark, sf):
    """Area under the ROC curve after each of the 10 rounds of the per-user-block
    model, on its training and validation rows (M3b)."""
    fields(spark, sf, TRAIN)
    tr, va = _in_parallel(*[(lambda s=s: _variant_dataset(spark, sf, s, "user_block")) for s in (TRAIN, VALIDATE)])
    sets = {"train": tr, "validate": va}
    run = BO.boost(spark, scratch_path(spark, f"gbt-watch-{uuid.uuid4().hex}"),
                   BO.training_table(sets, MD.feature_columns(tr)), MD.USER_BLOCK_PARAMS, train_sets=tuple(sets))
    return run.watched()


AUC_FEATURES = ["distance", "discount_rate", "min_cost_of_manjian", "is_manjian"]


def q_rank_auc(spark, sf):
    """How well each plain feature alone ranks the 15-day label of all label
    rows of the training split, by month of receipt."""
    _, label = fields(spark, sf)
    long = label.select("label", F.month("date_received").alias("received_month"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("score")) for c in AUC_FEATURES])).alias("x"))
    return RK.rank_auc(long.select("label", "received_month", "x.*"), ["feature", "received_month"])


QUERIES.update({
    "gbt_watch": q_gbt_watch,
    "rank_auc": q_rank_auc,
    "gbt_compact_predictions": q_gbt_compact_predictions,
    "gbt_user_block_predictions": q_gbt_user_block_predictions,
    "gbt_importance": q_gbt_importance,
})

# ---- files: written from the tables and read back -------------------------------------------
def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def q_csv_round_trip(spark, sf):
    """All coupon rows through an offline CSV log (K2, S1, C8) with values
    planted that their columns can't hold; what is read has the reason (P11)."""
    t = SK.offline_text(coupon_raw(spark, sf))
    key = lambda c, n: F.col(c).cast("bigint") % n == 0
    t = t.withColumns({
        "Distance": F.when(key("User_id", 97), F.lit("far")).otherwise(F.col("Distance")),
        "Date": F.when(key("Merchant_id", 13) & F.col("Date").isNotNull(), F.lit("20161345")).otherwise(F.col("Date")),
        "Date_received": F.when(key("User_id", 2), F.concat("Date_received", F.lit(".0"))).otherwise(F.col("Date_received"))})
    path = _scratch(spark, "csv")
    SK.write_offline_csv(t, path)
    return FL.read_quarantined(spark, path).drop("line")


LINE_VALUES = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_whitespace_round_trip(spark, sf):
    """Numbers of all line items through a text of columns apart by blanks (S3); what is no number is null."""
    li = read_table(spark, sf, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in LINE_VALUES])
    path = _scratch(spark, "text")
    SK.write_whitespace(li.withColumn("l_tax", F.when(F.col("l_linenumber") != 7, F.col("l_tax"))), path)
    return FL.read_whitespace_text(spark, path)


def q_registry_round_trip(spark, sf):
    """Line items in the shapes of three registered datasets (K1, S2, S4, S5, P6, P18): a letter to
    recode, a class column at the end, columns to drop by name."""
    li = read_table(spark, sf, "lineitem")
    value = [F.col(c).cast("double") for c in ("l_quantity", "l_discount")]
    letter = F.translate("l_returnflag", "ANR", "MIF")
    shapes = {"abalone": ([letter.alias("sex"), *value], False), "iris": ([*value, F.col("l_returnflag")], False),
              "wholesale": ([F.lit(1).alias("Channel"), F.lit(2).alias("Region"), *value], True)}
    out = None
    for name, (cols, header) in shapes.items():
        path = _scratch(spark, name)
        SK.write_csv(li.select(*cols), path, header=header)
        part = FL.load_dataset(spark, name, path).select(F.lit(name).alias("dataset"), "p")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES.update({
    "csv_round_trip": q_csv_round_trip,
    "whitespace_round_trip": q_whitespace_round_trip,
    "registry_round_trip": q_registry_round_trip,
})

#: Means of doubles: sums differ in the last bits between engines, so results are compared to 9 decimals.
MEANS = ("mean_distance", "receive_buy_mean_rate", "receive_use_mean", "15_mean_consume_distance",
         "history_field_User_id_receive_and_consume_mean_discount_rate",
         "history_field_User_id_receive_and_consume_mean_distance")


def _rounded(fn):
    def q(spark, sf):
        df = fn(spark, sf)
        return df.withColumns({c: F.round(F.col(f"`{c}`"), 9) for c in MEANS if c in df.columns})
    q.__name__, q.__doc__ = fn.__name__, fn.__doc__
    return q


for _name in [n for n in QUERIES if n.startswith(("feat_", "user_block", "dataset_", "train_union"))]:
    QUERIES[_name] = _rounded(QUERIES[_name])
