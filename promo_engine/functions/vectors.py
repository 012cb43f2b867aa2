"""Vector expressions on ``array<double>`` columns.

All are higher-order SQL functions evaluated in the JVM; sums fold the
array left to right, so the result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_doubles(c) -> Column:
    return F.transform(_c(c), lambda x: x.cast("double"))


def _literal(values) -> str | None:
    """SQL text of a constant ``array<double>``; ``repr`` gives the shortest
    text that parses back to the same double.  None with values that no text has."""
    vals = [float(v) for v in values]
    if any(v != v or v in (float("inf"), float("-inf")) for v in vals):
        return None
    return "array(" + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in vals) + ")"


def literal_vector(values) -> Column:
    """A constant ``array<double>``, built as one SQL literal (one JVM call
    instead of one per coordinate), bit-exact."""
    text = _literal(values)
    return F.array(*[F.lit(float(v)) for v in values]) if text is None else F.expr(text)


def squared_euclidean(a, b) -> Column:
    sq = F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v)


def euclidean(a, b) -> Column:
    """sqrt(sum((a - b)^2))."""
    return F.sqrt(squared_euclidean(a, b))


def manhattan(a, b) -> Column:
    """sum(|a - b|)."""
    ab = F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y))
    return F.aggregate(ab, F.lit(0.0), lambda acc, v: acc + v)


def dot(a, b) -> Column:
    p = F.zip_with(_c(a), _c(b), lambda x, y: x * y)
    return F.aggregate(p, F.lit(0.0), lambda acc, v: acc + v)


def nearest(point, centres: list[list[float]], metric: str = "euclidean") -> Column:
    """Index of the nearest centre; ties go to the lowest index.

    ``centres`` is the model state (k x d numbers, bounded by k), inlined as
    literals -- the same thing a broadcast of the centres does.
    """
    dist = euclidean if metric == "euclidean" else manhattan
    texts = [_literal(c) for c in centres]
    every = (F.array(*[literal_vector(c) for c in centres]) if None in texts
             else F.expr("array(" + ", ".join(texts) + ")"))        # one expression, however many centres
    return F.array_min(F.transform(every, lambda c, i: F.struct(dist(point, c).alias("d"), i.alias("i"))))["i"]
