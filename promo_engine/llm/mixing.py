"""Mixing sources to target weights by soft domain membership.

1. Domains are the label pairs of the labelled table (quality, toxic).  A
   multinomial logistic regression over hashed words, fitted on a bounded
   sample of the labelled rows, predicts every document's domain posteriors.
2. Document rates r >= 0 are fitted by projected-gradient least squares so
   that the expected domain totals  sum_i r_i tokens_i p_i  match the targets.
   Each pass is one Spark aggregate of a number per domain; a document's rate
   is a function of its posteriors and of the passes so far, so no table of
   rates is rewritten and a lost executor costs one pass.
3. A rate becomes whole copies by a hash of the row, right on average.

The residual is measured in the metric of the domains' Gram matrix
(sum_i tokens_i p_i p_i^T), so a unit step is never too long and mixed-up
domains converge as fast as clear ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.llm import common as C

#: (quality, toxic) and its target share of the tokens.
TARGETS = {(1, 0): 0.97, (1, 1): 0.01, (0, 0): 0.015, (0, 1): 0.005}
HASHED_WORDS = 1 << 12
MOST_LABELLED = 20_000
PASSES = 60
CLOSE = 1e-4
NEAR_ONE = 0.05


def _words(rows: DataFrame) -> DataFrame:
    """``words``: the text's lower-case words (null: none)."""
    text = F.lower(F.coalesce("text", F.lit("")))
    return rows.withColumn("words", F.filter(F.split(text, f"{C.SPACE_CLASS}+"), lambda w: w != ""))


def labelled(labels: DataFrame, domains: list[tuple[int, int]], id_col: str = "doc_id") -> DataFrame:
    """``doc_id, domain`` of rows whose label pair is a domain; of several rows for one id the least."""
    domain = F.lit(None).cast("int")
    for k, (q, t) in enumerate(domains):
        domain = F.when((F.col("quality") == q) & (F.col("toxic") == t), F.lit(k)).otherwise(domain)
    return (labels.select(F.col(id_col).cast("bigint").alias("doc_id"), domain.alias("domain"))
            .where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain")))


def fit_domains(rows: DataFrame, known: DataFrame, most: int = MOST_LABELLED):
    """(fitted pipeline or None, labelled domains); None if fewer than two domains are labelled.

    ``most`` bounds the labelled rows it learns from (by a hash of the id)."""
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    train = C.cut_lineage(_words(rows.join(known, "doc_id")).select("domain", "words"), "labelled")
    found = sorted(r["domain"] for r in train.select("domain").distinct().collect())
    if len(found) < 2:
        return None, found
    steps = [HashingTF(inputCol="words", outputCol="tf", numFeatures=HASHED_WORDS),
             Normalizer(inputCol="tf", outputCol="x", p=1.0),
             LogisticRegression(featuresCol="x", labelCol="domain", family="multinomial", maxIter=60, regParam=1e-5)]
    return Pipeline(stages=steps).fit(train), found


def posteriors(rows: DataFrame, labels: DataFrame, domains: list[tuple[int, int]],
               most: int = MOST_LABELLED) -> DataFrame:
    """``rows`` (doc_id, text, ...) with ``tokens`` and ``p``, the posteriors of ``domains``.

    A text without words has the labelled domain's prior; without any label
    the posteriors are equal, with one labelled domain it has them all."""
    model, found = fit_domains(rows.select("doc_id", "text"), labelled(labels, domains), most)
    words = _words(rows).withColumn("tokens", F.size("words").cast("bigint"))
    if model is None:
        flat = [1.0 / len(domains) if not found else float(k in found) for k in range(len(domains))]
        return words.withColumn("p", F.array(*map(F.lit, flat))).drop("words")
    out = model.transform(words).withColumn("p", vector_to_array("probability"))
    pad = F.array_repeat(F.lit(0.0), len(domains))
    return (out.withColumn("p", F.slice(F.concat("p", pad), 1, len(domains)))
            .drop("words", "tf", "x", "rawPrediction", "probability", "prediction"))


@dataclass
class Mix:
    """The fitted rates: the dual steps so far, the totals reached and the targets."""
    steps: np.ndarray
    totals: np.ndarray
    targets: np.ndarray
    passes: int


def rates(p: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rates of documents with posteriors ``p`` after the projected steps, from 1."""
    r = np.ones(len(p))
    for g in steps:
        r = np.maximum(0.0, r - p @ g)
    return r


def _matrix(b: pa.RecordBatch, d: int) -> np.ndarray:
    return np.asarray(b.column("p").flatten(), dtype=np.float64).reshape(b.num_rows, d)


def _total(rows: DataFrame, d: int, value) -> np.ndarray:
    """Sum over all rows of ``value(p, tokens)``, a vector per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = None
        for b in batches:
            if b.num_rows:
                v = value(_matrix(b, d), np.asarray(b.column("tokens"), dtype=np.float64))
                acc = v if acc is None else acc + v
        if acc is not None:
            yield pa.record_batch([pa.array(np.arange(len(acc)), type=pa.int32()), pa.array(acc)], names=["at", "v"])
    got = rows.select("tokens", "p").mapInArrow(run, "at int, v double").groupBy("at").agg(
        F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(got, key=lambda r: r["at"])])


def fit_rates(rows: DataFrame, shares: list[float], total: float | None = None, passes: int = PASSES,
              close: float = CLOSE) -> Mix:
    """Fit over ``rows`` (tokens, p).  ``total`` is the token budget; by default
    the one that leaves the first domain's expected tokens as they are."""
    d = len(shares)
    share = np.asarray(shares, dtype=np.float64)
    first = _total(rows, d, lambda p, t: np.concatenate([t @ p, ((p * t[:, None]).T @ p).ravel()]))
    if len(first) == 0 or first[:d].sum() == 0:
        return Mix(np.zeros((0, d)), np.zeros(d), np.zeros(d), 0)
    have, gram = first[:d], first[d:].reshape(d, d)
    targets = share / share.sum() * (have[0] / (share[0] / share.sum()) if total is None else total)
    metric = np.linalg.pinv(gram, rcond=1e-10)
    steps, reached, last = np.zeros((0, d)), have, have
    for k in range(passes + 1):
        met = np.abs(reached - targets).max() <= close * targets.sum()
        still = k and np.abs(reached - last).max() <= 0.01 * close * targets.sum()   # no rates get nearer
        if k == passes or met or still:
            return Mix(steps, reached, targets, k)
        steps, last = np.vstack([steps, metric @ (reached - targets)]), reached
        now = steps
        reached = _total(rows, d, lambda p, t: (t * rates(p, now)) @ p)
    raise AssertionError("unreachable")


def _rate_column(steps: np.ndarray, d: int):
    @F.arrow_udf("double")
    def rate(p: pa.Array) -> pa.Array:
        return pa.array(rates(np.asarray(p.flatten(), dtype=np.float64).reshape(len(p), d), steps))
    return rate


def _copies(rate, row_hash, near_one: float):
    """Whole copies whose mean is the rate: a uniform number from the row's hash rounds it."""
    u = F.pmod(row_hash, F.lit(1 << 40)) / float(1 << 40)
    near = F.when(F.abs(rate - 1) <= near_one, F.lit(1.0)).otherwise(rate)
    return F.floor(near + u).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[tuple[int, int], float] | None = None,
        total: float | None = None, id_col: str = "doc_id", text_col: str = "text",
        near_one: float = NEAR_ONE, most: int = MOST_LABELLED) -> tuple[DataFrame, Mix]:
    """One row per input row: ``doc_id, n_tokens, posteriors, rate, copies``, and the fit.

    Tokens are words; null and empty texts have none and don't bear on the
    totals, their posteriors are those of no words.  Rates within ``near_one``
    of 1 give one copy, so documents of a domain that has its share stay as
    they are; others are rounded up or down by the row's hash.  A null id is
    no label's; repeated rows get equal rates and copies each.  Targets that
    no nonnegative rates reach are met in the least-squares sense.  Other
    columns are not read; an empty table gives no rows and no passes.
    """
    targets = targets or TARGETS
    domains = list(targets)
    rows = C.id_text(docs, id_col, text_col).withColumn("row", F.xxhash64(F.lit(17), "doc_id", "text"))
    soft = C.cut_lineage(posteriors(rows, labels, domains, most).drop("text"), "posteriors")
    fitted = fit_rates(soft, [targets[k] for k in domains], total)
    rate = _rate_column(fitted.steps, len(domains))("p")
    return (soft.withColumn("rate", rate)
            .select("doc_id", F.col("tokens").alias("n_tokens"), F.col("p").alias("posteriors"), "rate",
                    _copies(F.col("rate"), F.col("row"), near_one).alias("copies"), "row"), fitted)


def mixed(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every row repeated as often as its copies say, other columns unchanged."""
    given, _ = mix(docs, labels, id_col=id_col, text_col=text_col, **how)
    row, copies, each = C.fresh(docs, "__row", "__copies", "__each")
    # rows of one hash are equal in id and text, so they have one answer
    given = given.groupBy(F.col("row").alias(row)).agg(F.first("copies").alias(copies))
    out = docs.withColumn(row, F.xxhash64(F.lit(17), F.col(id_col).cast("bigint"), F.col(text_col).cast("string")))
    return (out.join(given, row).where(F.col(copies) > 0)
            .withColumn(each, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(docs.columns))
