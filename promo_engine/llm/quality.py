"""Quality classifier: regularised quadratic discriminant over transformed
statistics of a document.

Each class has a Gaussian over the statistics, its covariance shrunk towards
the pooled one and towards its own diagonal.  The class sums (count, sum,
sum of products) are added up by Spark over all labelled training rows, a
few numbers per partition; the driver factors one small matrix per class,
and the cached Cholesky factors score every document by the difference of
the log densities (Mahalanobis distances and log determinants).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.llm import common as C

THRESHOLD = 0.3
POOLED = 0.1        # share of the pooled covariance
DIAGONAL = 0.02     # then share of the diagonal
FLOOR = 1e-4        # added variance, in units of the standardised statistics

_LOWER = np.zeros(256, dtype=bool)
_LOWER[ord("a"):ord("z") + 1] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:'\"-()?"]] = True
_OTHER = ~(_LOWER | _UPPER | _DIGIT | _SPACE | _STOP)
_OTHER[128:] = False

STATISTICS = ("log_bytes", "log_words", "mean_word", "sd_word", "upper", "digits", "stops", "symbols", "high_bytes",
              "distinct_words", "top_word", "same_as_previous", "log_line_words", "same_lines", "all_caps_words",
              "symbol_words", "long_words", "full_stops")


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text (zeros but for sizes if it has no words)."""
    words = text.split()
    buf = np.frombuffer(text, dtype=np.uint8)
    n, k = max(1, len(buf) - int(_SPACE[buf].sum())), len(words)
    counts = np.bincount(buf, minlength=256)
    share = lambda mask: float(counts[mask].sum()) / n
    root = lambda x: float(np.sqrt(x))
    if k == 0:
        return [float(np.log1p(len(buf)))] + [0.0] * (len(STATISTICS) - 1)
    lens = np.fromiter(map(len, words), dtype=np.float64, count=k)
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    again = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    caps = sum(len(w) > 1 and w.isupper() for w in words)
    odd = sum(bool(w.translate(None, _PLAIN)) for w in words)
    return [float(np.log1p(len(buf))), float(np.log1p(k)), float(np.log(lens.mean())), float(np.log1p(lens.std())),
            root(share(_UPPER)), root(share(_DIGIT)), root(share(_STOP)), root(share(_OTHER)),
            root(float(counts[128:].sum()) / n),
            float(len(tally)) / k ** 0.85, root((max(tally.values()) - 1) / k), root(again / k),
            float(np.log1p(k / max(1, len(lines)))), root(1 - len(set(lines)) / max(1, len(lines))),
            root(caps / k), root(odd / k), root(float((lens > 20).sum()) / k), root(counts[ord(".")] / k)]


#: Bytes of ordinary words; what is left of a word without them is a symbol.
_PLAIN = bytes(i for i in range(256) if not _OTHER[i])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x`` (array<double>) of each row; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array([statistics(t) for t in C.texts_of(b)],
                                                                type=pa.list_(pa.float64()))], names=["doc_id", "x"])
    return C.id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, x array<double>")


@dataclass
class Model:
    """Per class: log prior, mean, inverse Cholesky factor, half log determinant."""
    classes: dict[int, tuple[float, np.ndarray, np.ndarray, float]]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(label 1) of the rows of ``x``."""
        if len(self.classes) < 2:
            return np.full(len(x), self.prior)
        log = {}
        for k, (prior, mean, inv, half) in self.classes.items():
            z = (x - mean) @ inv.T
            log[k] = prior - half - 0.5 * np.einsum("ij,ij->i", z, z)
        return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def class_sums(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of ``x`` by ``label`` over all rows."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((2, 1 + d + d * d))
        for b in batches:
            if b.num_rows:
                x = np.array(b.column("x").flatten(), dtype=np.float64).reshape(b.num_rows, d)
                y = np.array(b.column("label"), dtype=np.int64)
                for k in (0, 1):
                    m = x[y == k]
                    acc[k] += np.concatenate([[len(m)], m.sum(0), (m.T @ m).ravel()])
        yield pa.record_batch([pa.array(np.repeat([0, 1], acc.shape[1]), type=pa.int32()),
                               pa.array(np.tile(np.arange(acc.shape[1]), 2), type=pa.int32()),
                               pa.array(acc.ravel())], names=["label", "at", "v"])
    got = (rows.select("x", F.col("label").cast("int").alias("label")).mapInArrow(run, "label int, at int, v double")
           .groupBy("label", "at").agg(F.sum("v").alias("v")).collect())
    acc = np.zeros((2, 1 + d + d * d))
    for r in got:
        acc[r["label"], r["at"]] = r["v"]
    return {k: (acc[k, 0], acc[k, 1:1 + d], acc[k, 1 + d:].reshape(d, d)) for k in (0, 1) if acc[k, 0] > 0}


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = POOLED, diagonal: float = DIAGONAL,
        floor: float = FLOOR) -> Model:
    total = sum(n for n, _, _ in sums.values())
    if len(sums) < 2:
        return Model({}, 0.5 if not sums else float(next(iter(sums))))
    means = {k: s / n for k, (n, s, _) in sums.items()}
    covs = {k: p / n - np.outer(means[k], means[k]) for k, (n, _, p) in sums.items()}
    within = sum(sums[k][0] * covs[k] for k in sums) / total
    unit = np.sqrt(np.maximum(np.diag(within), 1e-12))
    out = {}
    for k, (n, _, _) in sums.items():
        c = (1 - pooled) * covs[k] + pooled * within
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(c)) + floor * np.diag(unit ** 2) + 1e-9 * np.eye(len(c))
        low = np.linalg.cholesky(c)
        out[k] = (float(np.log(n / total)), means[k], np.linalg.inv(low), float(np.log(np.diag(low)).sum()))
    return Model(out, sums[1][0] / total)


def train(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          folds: int = 5, held_fold: int = 0) -> Model:
    """Fit on every labelled document whose fold isn't ``held_fold``; labels
    other than 0 and 1 and null ids are left out, a label given twice counts twice."""
    known = (labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & (C.doc_fold() != held_fold)))
    return fit(class_sums(feats.join(known, "doc_id")))


def apply(feats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``feats`` with ``score`` and ``predicted``."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("x").flatten(), dtype=np.float64).reshape(b.num_rows, d)
            s = model.score(x)
            yield pa.record_batch([b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                  names=["doc_id", "score", "predicted"])
    return feats.mapInArrow(run, "doc_id bigint, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    The score is P(label 1) from the text alone.  A null text counts as empty
    and gets the score of an empty text; a null id counts as not held out, its
    row is scored like any other; repeated rows are scored each.  Without
    labelled rows every score is 0.5, with one class alone it is that class.
    Other columns are not read; an empty table gives no rows.
    """
    feats = C.cut_lineage(features(docs, id_col, text_col), "quality")
    model = train(feats, labels, "doc_id", label_col)
    return apply(feats, model, threshold).select(
        "doc_id", F.coalesce(C.doc_fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, unchanged, that the classifier doesn't reject.

    The statistics of a text are computed once: they are written beside the
    row, and both the training and the scores read them there."""
    (mine,) = C.fresh(docs, "__statistics")
    rows = C.cut_lineage(docs.withColumn(mine, _statistics_column()(F.col(text_col).cast("string"))), "quality-rows")
    model = train(rows.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(mine).alias("x")), labels)
    return rows.where(_score_column(model)(F.col(mine)) >= threshold).drop(mine)


def _statistics_column():
    @F.arrow_udf("array<double>")
    def column(texts: pa.Array) -> pa.Array:
        raw = C.texts_of(pa.record_batch([texts], names=["text"]))
        return pa.array([statistics(t) for t in raw], type=pa.list_(pa.float64()))
    return column


def _score_column(model: Model):
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array(x.flatten(), dtype=np.float64).reshape(len(x), len(STATISTICS))))
    return score
