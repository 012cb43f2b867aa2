"""Watched, resumable boosting; exact AUC by ranks."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from promo_engine.operators import boost as B
from promo_engine.operators import model as MD
from promo_engine.operators import ranking as RK
from promo_engine.plans import catalog as K
from promo_engine.session import scratch_path

PARAMS = MD.Booster(eta=0.3, depth=3, rounds=6, subsample=0.9, colsample="0.7", min_child=1)
FEATURES = ["fa", "fb", "fc"]

# ROC area by ranks: a positive beats the negatives below it and half of those beside it
AUC_SQL = """with c as (select g, score, count_if(label = 1) as pos, count_if(label = 0) as neg from t
  where score is not null and label in (0, 1) group by g, score),
b as (select *, coalesce(sum(neg) over (partition by g order by score rows between unbounded preceding and 1 preceding), 0) as below from c)
select g, sum(pos)::bigint as n_pos, sum(neg)::bigint as n_neg,
  case when sum(pos) * sum(neg) > 0 then (sum(pos * (2 * below + neg))::double / 2.0) / (sum(pos)::double * sum(neg)::double) end as auc
from b group by g"""


@pytest.mark.parametrize("range_rows", [1_000_000, 37])
def test_rank_auc_is_duckdbs(spark, range_rows):
    rng = np.random.default_rng(3)
    rows = [(None if g == 5 else int(g), None if rng.random() < .02 else float(round(s, 2)), None if rng.random() < .02 else int(y))
            for g, s, y in zip(rng.integers(0, 6, 3000), rng.normal(size=3000), rng.integers(0, 3, 3000))]
    rows += [(7, 0.5, 1), (7, 0.25, 1), (8, None, 0), (9, 1.0, 0), (9, 1.0, 1)]
    df = spark.createDataFrame(rows, "g int, score double, label int")
    got = {r.g: (r.n_pos, r.n_neg, r.auc) for r in RK.rank_auc(df, ["g"], range_rows=range_rows).collect()}
    con = duckdb.connect()
    con.register("t", df.toPandas().astype({"g": "Int64", "label": "Int64"}))
    want = {r[0]: r[1:] for r in con.sql(AUC_SQL.replace("score is not null", "score is not null and not isnan(score)")).fetchall()}
    assert got == want and got[7][2] is None and got[9][2] == 0.5
    assert RK.rank_auc(df.limit(0), ["g"]).count() == 0


@pytest.fixture(scope="module")
def sets(spark):
    rng = np.random.default_rng(0)
    out = {}
    for name, n in (("train", 600), ("validate", 200)):
        a, b, c = rng.normal(size=(3, n))
        y = (a + 0.5 * b * c + 0.3 * rng.normal(size=n) > 0).astype(int)
        rows = [(i, i % 5, None, float(a[i]), float(b[i]) if i % 9 else None, float(c[i]), int(y[i])) for i in range(n)]
        out[name] = spark.createDataFrame(rows, "user_id long, coupon_id long, date_received date, fa double, fb double, "
                                                "fc double, label int")
    return out


def _folder(spark, name):
    import uuid
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _margins(run):
    return {r.row: r.margin for r in run.rows().collect()}


@pytest.fixture(scope="module")
def whole(spark, sets):
    return B.boost(spark, _folder(spark, "whole"), B.training_table(sets, FEATURES), PARAMS, batch=4)


def test_resumed_equals_straight(spark, sets, whole):
    folder = _folder(spark, "resumed")
    B.boost(spark, folder, B.training_table(sets, FEATURES), PARAMS, rounds=3, batch=2)
    run = B.boost(spark, folder, None, PARAMS, batch=4)
    assert whole.rounds() == run.rounds() == 6 and [t.round for t in run.trees()] == list(range(6))
    a, b = _margins(whole), _margins(run)
    assert set(a) == set(b) and max(abs(a[k] - b[k]) for k in a) < 1e-9
    for x, y in zip(whole.trees(), run.trees()):
        assert [n[:4] for n in x.nodes] == [n[:4] for n in y.nodes]
    auc = lambda r: {(w.round, w.set): w.auc for w in r.watched().collect()}
    assert auc(whole) == pytest.approx(auc(run), abs=1e-9) and len(auc(run)) == 12


def test_killed_between_batches_goes_on(spark, sets, whole, monkeypatch):
    folder = _folder(spark, "killed")
    real, calls = B.rank_auc, []

    def dies(*a, **b):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*a, **b)
    monkeypatch.setattr(B, "rank_auc", dies)
    with pytest.raises(RuntimeError):
        B.boost(spark, folder, B.training_table(sets, FEATURES), PARAMS, batch=2)
    assert B.Run(spark, folder).rounds() == 2
    run = B.boost(spark, folder, None, PARAMS, batch=2)
    a, b = _margins(whole), _margins(run)
    assert run.rounds() == 6 and max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_watched_auc_is_that_of_the_scores(spark, sets, whole):
    last = {r.set: r.auc for r in whole.watched().where("round = 5").collect()}
    want = {r.set: r.auc for r in RK.rank_auc(whole.rows().select("set", "label", F.col("margin").alias("score")), ["set"]).collect()}
    assert last == want and last["train"] > 0.85 and last["validate"] > 0.75
    first = {r.set: r.auc for r in whole.watched().where("round = 0").collect()}
    assert first["train"] < last["train"]
    prob = {r.user_id: r.prob for r in B.predictions(whole, sets["validate"], FEATURES, PARAMS.eta, batch=4).collect()}
    again = B.predictions(whole, sets["validate"], FEATURES, PARAMS.eta, batch=2).collect()
    assert len(prob) == 200 and all(abs(prob[r.user_id] - r.prob) < 1e-12 and 0 < r.prob < 1 for r in again)
    used = B.importance(whole, FEATURES).collect()
    assert max(used, key=lambda r: r.gain_importance).feature_name == "fa"
    assert [r.importance for r in used] == sorted((r.importance for r in used), reverse=True)
    assert sum(r.importance for r in used) == sum(n[1] >= 0 for t in whole.trees() for n in t.nodes)


def test_a_round_is_a_newton_step(spark):
    """One split, no sampling: leaves are -G / (H + 1) of their rows."""
    rows = [(i, 1, None, float(i >= 30), int(i % 4 == 0 if i < 30 else i % 4 > 0)) for i in range(100)]
    df = spark.createDataFrame(rows, "user_id long, coupon_id long, date_received date, x double, label int")
    p = MD.Booster(eta=1.0, depth=1, rounds=1)
    run = B.boost(spark, _folder(spark, "newton"), B.training_table({"train": df}, ["x"]), p, watch=False)
    got = {r.x: r.margin for r in run.rows().select(F.col("f")[0].alias("x"), "margin").distinct().collect()}
    y, x = np.array([r[4] for r in rows]), np.array([r[3] for r in rows])
    for side in (0.0, 1.0):
        g, h = (0.5 - y[x == side]).sum(), 0.25 * (x == side).sum()
        assert got[side] == pytest.approx(-g / (h + 1))


def test_published_rounds_on_the_main_features(spark, sf):
    """Two batches of the main parameter set on the assembled rows of both sets."""
    tr, va = K._main_dataset(spark, sf, K.TRAIN), K._main_dataset(spark, sf, K.VALIDATE)
    feats = MD.feature_columns(tr)
    run = B.boost(spark, _folder(spark, "main"), B.training_table({"train": tr, "validate": va}, feats), MD.MAIN_PARAMS,
                  rounds=4, batch=2, train_sets=("train", "validate"))
    assert run.rounds() == 4 and MD.MAIN_PARAMS.rounds == 3000
    assert {(r.round, r.set) for r in run.watched().collect()} == {(i, s) for i in range(4) for s in ("train", "validate")}
