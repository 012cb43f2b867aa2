"""Exact quantiles without gathering a column into one task.

Selection by histogram refinement: for every target rank, keep a value
interval [lo, hi] known to contain it and the number of values below lo.
Each pass buckets the values inside every open interval (4096 buckets per
search, all searches in one grouped aggregate with partial aggregation),
finds the bucket holding the rank and shrinks the interval to that
bucket's actual min/max.  A search ends when its interval is one value.
Driver state is bounded by (searches x buckets); the data never leaves the
executors.  Ties and discrete data end in one or two passes; continuous
doubles shrink 4096-fold per pass.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.session import cut_lineage

BUCKETS = 4096
MAX_PASSES = 200
MEDIAN_ROWS = 250_000    # distinct values of one key that one task walks through
MEDIAN_PARTS = 64        # ranges that a key of more values is cut into


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    pos = (n - 1) * p
    lo = math.floor(pos)
    return lo, min(lo + 1, n - 1), pos - lo


def kth_values(long: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """Exact k-th smallest (0-based) non-null ``value`` per ``column_name``."""
    inf = float("inf")
    data = long.where(F.col("value").isNotNull() & ~F.isnan("value")).select("column_name", "value")
    finite = F.when(F.abs("value") < inf, F.col("value"))
    stats = {r["column_name"]: r for r in
             data.groupBy("column_name").agg(F.min(finite).alias("lo"), F.max(finite).alias("hi"), F.count(finite).alias("n"),
                                             F.count_if(F.col("value") == -inf).alias("low")).collect()}
    data = data.where(F.abs("value") < inf)
    # search id -> [column, rank, lo, hi, count below lo]; infinite ranks are known already
    open_ = {}
    done: dict[tuple[str, int], float] = {}
    for c, ks in wanted.items():
        for k in sorted(set(ks)):
            s = stats[c]
            if s["low"] <= k < s["low"] + s["n"]:
                open_[len(open_)] = [c, k, float(s["lo"]), float(s["hi"]), s["low"]]
            else:
                done[(c, k)] = -inf if k < s["low"] else inf
    for _ in range(MAX_PASSES):
        for sid, (c, k, lo, hi, below) in list(open_.items()):
            if lo == hi:
                done[(c, k)] = lo
                del open_[sid]
        if not open_:
            return done
        searches = F.array(*[F.struct(F.lit(sid).alias("sid"), F.lit(c).alias("c"),
                                      F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                             for sid, (c, k, lo, hi, below) in open_.items()])
        s = F.explode(F.filter(searches, lambda t: (t["c"] == F.col("column_name"))
                               & (F.col("value") >= t["lo"]) & (F.col("value") <= t["hi"])))
        tagged = data.select("value", s.alias("t"))
        # divided first: the range of finite doubles may be no finite double; at least the least double
        width = F.greatest(F.col("t.hi") / F.lit(float(BUCKETS)) - F.col("t.lo") / F.lit(float(BUCKETS)), F.lit(5e-324))
        place = F.col("value") / width - F.col("t.lo") / width
        bucket = F.greatest(F.lit(0), F.least(F.floor(F.least(place, F.lit(float(BUCKETS)))), F.lit(BUCKETS - 1))).cast("int")
        hist = (tagged.groupBy(F.col("t.sid").alias("sid"), bucket.alias("b"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("mn"), F.max("value").alias("mx"))
                .collect())
        per = {}
        for r in hist:
            per.setdefault(r["sid"], []).append((r["b"], r["n"], r["mn"], r["mx"]))
        for sid, rows in per.items():
            c, k, lo, hi, below = open_[sid]
            acc = below
            for b, n, mn, mx in sorted(rows):
                if acc + n > k:
                    open_[sid] = [c, k, float(mn), float(mx), acc]
                    break
                acc += n
    raise RuntimeError("quantile search did not converge")


def exact_quantiles(long: DataFrame, probs=(0.25, 0.5, 0.75)) -> dict[str, list[float]]:
    """Linear-interpolated quantiles (the ``percentile`` / ``quantile_cont``
    definition) per ``column_name`` of a long (column_name, value) table."""
    counts = {r["column_name"]: r["n"] for r in
              long.groupBy("column_name").agg(F.count(F.when(~F.isnan("value"), F.col("value"))).alias("n")).collect()}
    wanted = {c: [r for p in probs for r in _ranks(n, p)[:2]] for c, n in counts.items() if n > 0}
    kth = kth_values(long, wanted)
    out = {}
    for c, n in counts.items():
        vals = []
        for p in probs:
            if n == 0:
                vals.append(None)
                continue
            a, b, frac = _ranks(n, p)
            x, y = kth[(c, a)], kth[(c, b)]
            vals.append(x if x == y else x + (y - x) * frac if frac else x)
        out[c] = vals
    return out


# ---- grouped medians ------------------------------------------------------------------
def grouped_medians(counts: DataFrame, keys: list[str], most: int = MEDIAN_ROWS, parts: int = MEDIAN_PARTS) -> DataFrame:
    """``keys..., median``: the exact median of every key from a table
    ``keys..., value, n`` of how often each value (double, not null) occurs.

    The middle ranks are found by running counts over the distinct values of
    a key.  Keys of more than ``most`` values are first cut into ``parts``
    ranges at their own (approximate) quantiles; the counts per range tell
    which range holds a middle rank, and only its values stay.  This repeats
    until no key has more than ``most`` values left, so a key that holds most
    of the rows never meets in one task, however many values it has.
    """
    rows = cut_lineage(counts.select(*keys, "value", "n"), "median-counts")
    group = list(keys)
    for level in range(MAX_PASSES):
        if rows.count() <= most:          # the written table's row count, from its footers
            break
        sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("__rows"), F.sum("n").alias("__all"))
        if (sizes.agg(F.max("__rows")).first()[0] or 0) <= most:
            break
        rows = cut_lineage(_narrowed(rows, sizes, group, f"__part{level}", most, parts), "median-range")
        group.append(f"__part{level}")
    if group == list(keys):
        rows = rows.withColumns({"__before": F.lit(0).cast("bigint"), "__total": F.sum("n").over(Window.partitionBy(*group))})
    end = F.col("__before") + F.sum("n").over(
        Window.partitionBy(*group).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    low, high = F.expr("(__total - 1) div 2"), F.expr("__total div 2")
    at = lambda rank: F.max(F.when((F.col("__end") - F.col("n") <= rank) & (rank < F.col("__end")), F.col("value")))
    ends = rows.withColumn("__end", end).groupBy(*keys).agg(at(low).alias("__low"), at(high).alias("__high"))
    return ends.select(*keys, F.when(F.col("__low") == F.col("__high"), F.col("__low"))
                       .otherwise(F.col("__low") * 0.5 + F.col("__high") * 0.5).alias("median"))


def _on(left: DataFrame, right: DataFrame, names: list[str]) -> tuple[DataFrame, Column]:
    """``right`` with other names for the keys, and the condition that joins it to ``left`` (null to null)."""
    other = right.select(*[F.col(c).alias(f"__r_{c}") if c in names else F.col(c) for c in right.columns])
    return other, reduce(lambda a, b: a & b, [left[c].eqNullSafe(other[f"__r_{c}"]) for c in names])


def _narrowed(rows: DataFrame, sizes: DataFrame, group: list[str], part: str, most: int, parts: int) -> DataFrame:
    """The rows in ranges that hold a middle rank, with the range (0 in keys
    that are small enough), the rows before it and the total."""
    first = "__total" not in rows.columns
    sizes = cut_lineage(sizes, "median-sizes")
    big, on = _on(rows, sizes.where(F.col("__rows") > most).drop("__rows", "__all"), group)
    edges = (rows.join(big, on, "left_semi").groupBy(*group).agg(F.percentile_approx(
        "value", [i / parts for i in range(1, parts)], parts * 20).alias("__edges")))
    edges, on = _on(rows, cut_lineage(edges, "median-edges"), group)
    below = F.size(F.filter(F.col("__edges"), lambda e: e < F.col("value")))
    cut = rows.join(edges, on, "left").withColumn(part, F.when(F.col("__edges").isNull(), 0).otherwise(below))
    cut = cut_lineage(cut.select(*rows.columns, part), "median-ranges")
    state = [] if first else [F.first("__before").alias("__from"), F.first("__total").alias("__total")]
    per = cut.groupBy(*group, part).agg(F.sum("n").alias("__n"), *state)
    if first:
        totals, on = _on(per, sizes.drop("__rows").withColumnRenamed("__all", "__total"), group)
        per = per.join(totals, on).select(*group, part, "__n", F.lit(0).cast("bigint").alias("__from"), "__total")
    running = F.sum("__n").over(Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per = (per.withColumn("__end", F.col("__from") + running).withColumn("__before", F.col("__end") - F.col("__n"))
           .where((F.col("__before") <= F.expr("__total div 2")) & (F.col("__end") > F.expr("(__total - 1) div 2"))))
    keep, on = _on(cut, per.select(*group, part, "__before", "__total"), [*group, part])
    return cut.drop("__before", "__total").join(keep, on).select(*group, part, "value", "n", "__before", "__total")
