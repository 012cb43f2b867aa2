"""End-to-end jobs on the original inputs (offline coupon CSV logs and the
clustering datasets).  Each returns DataFrames / small results and writes
with the executors; nothing is gathered on the driver except model state.

* ``coupon_model_job`` (E1): read -> clean -> label -> split -> datasets ->
  boosted trees -> scored test rows (+ importance), for the main, compact
  or per-user-block variant.
* ``clustering_job`` (E2): dataset -> PCA 2-D -> choose k -> final fit ->
  assignment and report.
* ``report_job`` (E3): cleaned export + the eight chart tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from promo_engine.operators import clean as CL
from promo_engine.operators import cluster as CU
from promo_engine.operators import dataset as DS
from promo_engine.operators import model as MD
from promo_engine.operators import reports as R
from promo_engine.plans import materialize as MZ
from promo_engine.plans import split as SP
from promo_engine.session import cut_lineage
from promo_engine.sources import files as FL
from promo_engine.sources.sinks import write_csv

VARIANTS = {
    "main": (DS.assemble_main, SP.MAIN_SPLITS, MD.MAIN_PARAMS, True),
    "compact": (DS.assemble_compact, SP.COMPACT_SPLITS, MD.COMPACT_PARAMS, False),
    "user_block": (None, SP.MAIN_SPLITS, MD.USER_BLOCK_PARAMS, True),
}


@dataclass
class ModelJobResult:
    predictions: DataFrame
    importance: DataFrame
    train_auc: float


def build_datasets(spark: SparkSession, cleaned: DataFrame, test_cleaned: DataFrame,
                   variant: str = "main", token: str = "") -> dict[str, DataFrame]:
    assemble, splits, _, _ = VARIANTS[variant]
    out = {}
    for s in splits:
        history, label = MZ.fields(spark, cleaned, s, token, test_table=test_cleaned, family=splits)
        if variant == "user_block":
            out[s.name] = DS.assemble_user_block(label)
        else:
            out[s.name] = assemble(label, history)
    return out


def coupon_model_job(spark: SparkSession, train_csv: str, test_csv: str, variant: str = "main",
                     rounds: int | None = None, out_dir: str | None = None) -> ModelJobResult:
    train = CL.labelled(FL.read_offline_csv(spark, train_csv))
    test = CL.clean(FL.read_offline_csv(spark, test_csv))
    sets = build_datasets(spark, train, test, variant, token=f"{train_csv}|{test_csv}")
    _, _, params, drop_ids = VARIANTS[variant]
    fit_on = DS.train_union(*[sets[k] for k in sets if k != "test"])
    fm = MD.fit(fit_on, params, rounds=rounds, drop_ids=drop_ids)
    pred = MD.score(fm, sets["test"])
    if out_dir:
        write_csv(pred, f"{out_dir.rstrip('/')}/result", header=False)   # K1
    return ModelJobResult(pred, MD.importance(fm), MD.train_auc(fm))


@dataclass
class ClusteringResult:
    scores: DataFrame
    k: int
    assigned: DataFrame
    report: DataFrame


def clustering_job(spark: SparkSession, name: str, path: str, method: str = "lloyd",
                   seed: int = 0, ks=CU.K_RANGE) -> ClusteringResult:
    pts = CU.pca_2d(FL.load_dataset(spark, name, path)).select("id", "p")
    scores = CU.choose_k(pts, ks=ks, seed=seed, method=method)
    k = scores.where("chosen = 1").first()["k"]
    if method == "lloyd":
        assigned = CU.lloyd_kmeans(pts, k, seed).assigned
    else:
        _, assigned = CU.mllib_kmeans(pts, k, seed)
    return ClusteringResult(scores, k, assigned, CU.cluster_report(assigned))


def report_job(spark: SparkSession, test_csv: str, out_dir: str | None = None) -> dict[str, DataFrame]:
    raw = cut_lineage(FL.read_offline_csv(spark, test_csv), "report-input")   # the text is scanned once
    rep = CL.report_clean(raw)
    tables = {
        "null_profile": R.null_profile(raw),
        "daily_received": R.daily_received(rep),
        "distance_counts": R.distance_counts(rep),
        "label_rate_by_distance": R.label_rate_by_distance(rep),
        "received_vs_label_by_rate": R.received_vs_label_by_rate(rep),
        "weekday_counts": R.weekday_counts(rep),
        "coupon_type_share": R.coupon_type_share(rep),
        "coupon_type_share_positive": R.coupon_type_share_positive(rep),
        "label_share": R.label_share(rep),
    }
    if out_dir:
        write_csv(rep, f"{out_dir.rstrip('/')}/cleaned", header=True)   # K2
    return tables
