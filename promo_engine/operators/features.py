"""Feature blocks of the coupon pipeline, compiled from declarative specs.

A spec says: take rows of the label field (``L``) or the history field
(``H``), keep those matching a condition, group by some keys, aggregate, and
attach the value to every label-field row with the same keys (a left join:
no matching group -> null).

Compilation
-----------
Specs are grouped by key set.  For each key set ONE grouped aggregate is run
over ``L`` (and ``H`` when needed: both are unioned with a source tag), with
one *conditional* aggregate per spec.  The result -- one row per key -- is
then left-joined to the label rows.  So the ~50 merges of a feature block
become one aggregate + one join per key set (10 for the main block).

Why grouped aggregates and not windows: a window over ``user_id`` puts every
row of a user into one task, and one user (or merchant) may hold a third of
all rows.  A grouped aggregate pre-aggregates on every map task (partial
aggregation), so a hot key costs one small state per partition; the join
back is a many-to-one equi-join which AQE either broadcasts (its runtime
size check) or runs as a sort-merge join whose skewed partitions it splits.

Null semantics (pandas group-by drops null keys; merge leaves null):
  * counts are ``nullif(count_if(cond), 0)`` -- no matching row -> null;
  * min/max/mean aggregate ``when(cond, value)`` -> null when none; so do
    medians, which are selected from value counts (``_medians``);
  * key sets made of label-field keys only join null-safe (a null key of the
    label field forms its own group, as the pipeline's coercion to 0 did).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promo_engine.functions import coupon as C
from promo_engine.operators import quantiles as Q
from promo_engine.session import cut_lineage_all

U, M, CP, DR, DIST, RATE = "user_id", "merchant_id", "coupon_id", "date_received", "distance", "discount_rate"


@dataclass(frozen=True)
class Spec:
    """One feature: ``agg(value) where cond`` over ``src`` rows grouped by ``keys``."""
    name: str
    src: str                 # "L" (label field) or "H" (history field)
    keys: tuple[str, ...]
    agg: str                 # count | min | max | mean | median | ndistinct | repeat | first | last
    value: str | None = None
    cond: str | None = None  # name in CONDITIONS


# Row conditions: name -> (SQL predicate, columns it reads).
CONDITIONS = {
    "used_received": ("date_used IS NOT NULL AND date_received IS NOT NULL", ("date_used", "date_received")),
    "used_coupon": ("date_used IS NOT NULL AND coupon_id IS NOT NULL", ("date_used", "coupon_id")),
    "used": ("date_used IS NOT NULL", ("date_used",)),
    "received": ("date_received IS NOT NULL", ("date_received",)),
    "coupon": ("coupon_id IS NOT NULL", ("coupon_id",)),
    "threshold_received": ("date_received IS NOT NULL AND is_manjian = 1", ("date_received", "is_manjian")),
    "redeemed": ("label = 1", ("label",)),
    "known_distance": ("distance <> -1", ("distance",)),
    "has_rate": ("discount_rate_raw IS NOT NULL", ("discount_rate_raw",)),
}

# Derived per-row values: name -> (SQL expression, columns it reads).
VALUES = {
    "use_gap": ("datediff(date_received, date_used)", ("date_received", "date_used")),    # C11
    "consume_gap": ("datediff(date_used, date_received)", ("date_used", "date_received")),  # C12
    "distance0": ("CASE WHEN distance = -1 THEN 0 ELSE distance END", ("distance",)),      # C20
}


def _s(name, src, keys, agg, value=None, cond=None):
    return Spec(name, src, tuple(keys), agg, value, cond)


# --- main block (F01-F56) -------------------------------------------------
MAIN_SPECS = [
    _s("consume", "L", [U], "count"),
    _s("if_first_time", "L", [U], "first", DR),
    _s("if_last_time", "L", [U], "last", DR),
    _s("min_distance_x", "H", [U], "min", DIST, "used_received"),
    _s("max_distance_x", "H", [U], "max", DIST, "used_received"),
    _s("mean_distance", "H", [U], "mean", DIST, "used_received"),
    _s("receive_buy_median_distance", "H", [U], "median", DIST, "used_coupon"),
    _s("receive_buy_mean_rate", "H", [U], "mean", RATE, "used_coupon"),
    _s("Coupon_amount", "L", [U], "count", None, "coupon"),
    _s("User_received_total_coupon", "L", [U], "count", None, "received"),
    _s("manjian_coupon", "L", [U], "count", None, "threshold_received"),
    _s("User_Date_received_x", "L", [U, DR], "count", None, "received"),
    _s("User_Date_received_special_Coupon", "L", [U, CP, DR], "count"),
    _s("User_if_same_Date_received_special_Coupon", "L", [U, CP, DR], "repeat"),
    _s("get_consume", "H", [U], "count", None, "used_coupon"),
    _s("receive_use_mean", "H", [U], "mean", "use_gap", "used_coupon"),
    _s("receive_use_median", "H", [U], "median", "use_gap", "used_coupon"),
    _s("receive_use_max", "H", [U], "max", "use_gap", "used_coupon"),
    _s("receive_use_min", "H", [U], "min", "use_gap", "used_coupon"),
    _s("cunsume_cnt_x", "H", [M], "count", None, "used"),
    _s("Merchant_use_coupon_amount", "H", [M], "count"),           # filter is a no-op (always true)
    _s("receive_consume_cnt", "H", [M], "count", None, "used_received"),
    _s("receive_cnt_x", "H", [M], "count", None, "received"),
    _s("Coupon_Merchant_min_distance", "H", [M], "min", DIST),     # filter is a no-op
    _s("15_max_consume_distance", "H", [M], "max", "distance0", "redeemed"),
    _s("15_mean_consume_distance", "H", [M], "mean", "distance0", "redeemed"),
    _s("cunsume_cnt_y", "H", [CP], "count", None, "used"),
    _s("receive_coupon_in_different_merchant", "L", [U, M], "count", None, "coupon"),
    _s("receive_use__coupon_in_different_merchant", "H", [U, M], "count", None, "used_coupon"),
    _s("receive1_cnt", "H", [U, M], "count", None, "received"),
    _s("User_Merchant_manjian_coupon", "L", [U, M], "count", None, "threshold_received"),
    _s("15_max_consume_gap", "H", [U, M], "max", "consume_gap", "redeemed"),
    _s("User_different_Merchant", "H", [U, M], "count"),           # filter is a no-op
    _s("User_Merchant_per_consume", "L", [U, M], "count"),
    _s("User_Merchant_Coupon_per_consume", "L", [U, M, CP], "count"),
    _s("User_received_Distance", "L", [U, DIST], "count"),
    _s("receive_cnt_y", "H", [U], "count", None, "received"),
    _s("differ_coupon_cnt", "H", [U], "ndistinct", CP, "received"),
    _s("User_Date_received_y", "L", [U, DR], "count"),
    _s("User_Date_received_coupon", "L", [U, CP, DR], "count"),
    _s("min_discount_rate", "H", [U], "min", RATE, "used_received"),
    _s("max_discount_rate", "H", [U], "max", RATE, "used_received"),
    _s("min_distance_y", "L", [U], "min", DIST, "known_distance"),
    _s("max_distance_y", "H", [U], "max", "distance0", "used_received"),
    _s("receive_cnt", "H", [M], "count", None, "received"),
    _s("Merchant_received_special_coupon", "L", [M, CP], "count", None, "received"),
    _s("different_rate_coupon_amount", "L", [RATE], "count", None, "has_rate"),
    _s("different_merchant_receive_consume", "L", [U], "ndistinct", M, "known_distance"),
    _s("different_merchant_receive", "L", [U], "ndistinct", M),
    _s("Merchant_Coupon_amount", "L", [M], "count"),
]

# Row-level features computed after the joins: (name, kind, x, y).
MAIN_ROW_FEATURES = [
    ("User_manjian_rate", "guarded", "manjian_coupon", "User_received_total_coupon"),
    ("cut_price", "cut", None, None),
    ("receive_rate", "plain", "get_consume", "Coupon_amount"),
    ("User_Merchant_manjian_rate", "guarded", "User_Merchant_manjian_coupon", "receive1_cnt"),
    ("consume_rate", "plain", "15_max_consume_gap", "receive_coupon_in_different_merchant"),
    ("merchant_consume_rate", "plain", "different_merchant_receive_consume", "different_merchant_receive"),
]

# Output order of the main block (the order the features are produced in).
MAIN_ORDER = [
    "consume", "if_first_time", "if_last_time", "min_distance_x", "max_distance_x",
    "mean_distance", "receive_buy_median_distance", "receive_buy_mean_rate", "Coupon_amount",
    "User_received_total_coupon", "manjian_coupon", "User_Date_received_x", "User_manjian_rate",
    "User_Date_received_special_Coupon", "User_if_same_Date_received_special_Coupon",
    "get_consume", "receive_use_mean", "receive_use_median", "receive_use_max", "receive_use_min",
    "cunsume_cnt_x", "Merchant_use_coupon_amount", "receive_consume_cnt", "receive_cnt_x",
    "Coupon_Merchant_min_distance", "15_max_consume_distance", "15_mean_consume_distance",
    "cut_price", "cunsume_cnt_y", "receive_rate", "receive_coupon_in_different_merchant",
    "receive_use__coupon_in_different_merchant", "receive1_cnt", "User_Merchant_manjian_coupon",
    "User_Merchant_manjian_rate", "15_max_consume_gap", "consume_rate", "User_different_Merchant",
    "User_Merchant_per_consume", "User_Merchant_Coupon_per_consume", "User_received_Distance",
    "receive_cnt_y", "differ_coupon_cnt", "User_Date_received_y", "User_Date_received_coupon",
    "min_discount_rate", "max_discount_rate", "min_distance_y", "max_distance_y", "receive_cnt",
    "Merchant_received_special_coupon", "different_rate_coupon_amount",
    "different_merchant_receive_consume", "different_merchant_receive", "merchant_consume_rate",
    "Merchant_Coupon_amount",
]

# The compact variant, a subset of the same features.
COMPACT_ORDER = [
    "consume", "min_distance_x", "max_distance_x", "mean_distance", "receive_buy_mean_rate",
    "Coupon_amount", "User_received_total_coupon", "manjian_coupon", "User_Date_received_x",
    "User_manjian_rate", "User_Date_received_special_Coupon",
    "User_if_same_Date_received_special_Coupon", "get_consume", "receive_use_mean",
    "receive_use_max", "receive_use_min", "cunsume_cnt_x", "Merchant_use_coupon_amount",
    "receive_consume_cnt", "receive_cnt_x", "cut_price", "cunsume_cnt_y", "receive_rate",
    "receive_coupon_in_different_merchant", "receive_use__coupon_in_different_merchant",
    "receive1_cnt", "User_Merchant_manjian_coupon", "User_Merchant_manjian_rate",
    "User_received_Distance", "receive_cnt_y", "User_Date_received_y", "min_discount_rate",
    "max_discount_rate", "min_distance_y", "max_distance_y", "receive_cnt",
    "Merchant_received_special_coupon", "different_rate_coupon_amount",
]

VARIANTS = {"main": MAIN_ORDER, "compact": COMPACT_ORDER}


def specs_for(names) -> list[Spec]:
    by = {s.name: s for s in MAIN_SPECS}
    needed = set(names)
    for n, _, x, y in MAIN_ROW_FEATURES:
        if n in needed and x:
            needed.update([x, y])
    return [s for s in MAIN_SPECS if s.name in needed]


# --------------------------------------------------------------------------
def prepare_label_field(label: DataFrame) -> DataFrame:
    """P12 on the label field: a missing coupon id becomes 0 (as the pipeline
    does before building features)."""
    return label.withColumn(CP, F.coalesce(F.col(CP), F.lit(0).cast("bigint")))


def _cond(name: str | None) -> Column:
    return F.lit(True) if name is None else F.expr(CONDITIONS[name][0])


def _value(name: str | None) -> Column:
    if name is None:
        return F.lit(1)
    return F.expr(VALUES[name][0]) if name in VALUES else F.col(name)


def _columns_read(spec: Spec) -> set[str]:
    cols = set(spec.keys)
    if spec.cond:
        cols.update(CONDITIONS[spec.cond][1])
    if spec.value:
        cols.update(VALUES[spec.value][1] if spec.value in VALUES else (spec.value,))
    return cols


def _agg(spec: Spec, tag: Column) -> Column:
    """Conditional aggregate of one spec over the (possibly unioned) rows."""
    c = tag & _cond(spec.cond)
    v = F.when(c, _value(spec.value))
    a = spec.agg
    if a == "count":
        out = F.nullif(F.count_if(c), F.lit(0))
    elif a == "repeat":   # C22: 1 when the group has more than one row
        n = F.count_if(c)
        out = F.when(n == 0, F.lit(None).cast("int")).when(n > 1, 1).otherwise(0)
    elif a in ("min", "first"):
        out = F.min(v)
    elif a in ("max", "last"):
        out = F.max(v)
    elif a == "mean":
        out = C.stable_mean(v)
    else:   # "ndistinct" and "median" are compiled separately (see _distinct_counts, _medians)
        raise ValueError(a)
    return out.alias(spec.name)


def group_blocks(specs: list[Spec]) -> list[tuple[tuple[str, ...], list[Spec]]]:
    """Specs grouped by key set, in first-appearance order."""
    blocks: dict[tuple[str, ...], list[Spec]] = {}
    for s in specs:
        blocks.setdefault(s.keys, []).append(s)
    return list(blocks.items())


def _source_rows(label: DataFrame, history: DataFrame | None, keys, specs) -> tuple[DataFrame, Column, Column]:
    """Rows feeding one key set: label and/or history, pruned to the columns
    the specs read, with a source tag."""
    srcs = {s.src for s in specs}
    cols = sorted(set(keys).union(*[_columns_read(s) for s in specs]))
    parts = []
    if "L" in srcs:
        parts.append(label.select(*[F.col(c) if c in label.columns else F.lit(None).alias(c)
                                    for c in cols], F.lit(True).alias("__is_l")))
    if "H" in srcs:
        if history is None:
            raise ValueError("history field required")
        parts.append(history.select(*cols, F.lit(False).alias("__is_l")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows, F.col("__is_l"), ~F.col("__is_l")


def _distinct_counts(rows: DataFrame, keys, specs: list[Spec], is_l: Column, is_h: Column) -> list[DataFrame]:
    """Distinct counts as explicit two-level aggregates, one table per value column.

    Level 1 groups by (keys, value) with one "seen under this spec's
    condition" flag per spec; level 2 counts the flagged values per key.
    Both levels aggregate partially before their shuffle, and -- unlike the
    built-in rewrite of several ``count(distinct)`` -- the other aggregates
    of the block are not expanded along with them.
    """
    out = []
    for v in sorted({s.value for s in specs}):
        vs = [s for s in specs if s.value == v]
        flags = [F.max(F.when((is_l if s.src == "L" else is_h) & _cond(s.cond), F.lit(1))).alias(f"__f{i}")
                 for i, s in enumerate(vs)]
        pairs = rows.where(_value(v).isNotNull()).groupBy(*keys, _value(v).alias("__v")).agg(*flags)
        counts = pairs.groupBy(*keys).agg(
            *[F.nullif(F.count_if(F.col(f"__f{i}") == 1), F.lit(0)).alias(s.name) for i, s in enumerate(vs)])
        out.append(counts)
    return out


def _medians(rows: DataFrame, keys, specs: list[Spec], is_l: Column, is_h: Column) -> DataFrame:
    """Exact medians of one key set: the values of all specs are counted by
    (keys, spec, value) with partial aggregation, and the middle ranks are
    selected from the counts (``quantiles.grouped_medians``).  A key's rows
    are never held together, as the built-in median's state does."""
    values = F.array(*[F.struct(F.lit(i).alias("spec"), F.when(
        (is_l if s.src == "L" else is_h) & _cond(s.cond), _value(s.value).cast("double")).alias("value"))
        for i, s in enumerate(specs)])
    long = rows.select(*keys, F.explode(F.filter(values, lambda x: x["value"].isNotNull())).alias("__x"))
    counts = (long.groupBy(*keys, F.col("__x.spec").alias("__spec"), F.col("__x.value").alias("value"))
              .agg(F.count(F.lit(1)).alias("n")))
    return Q.grouped_medians(counts, [*keys, "__spec"]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("__spec") == i, F.col("median"))).alias(s.name) for i, s in enumerate(specs)])


def aggregate_block(label: DataFrame, history: DataFrame | None, keys, specs) -> DataFrame:
    """One row per key: all aggregates of one key set (partial aggregation).

    Null keys form no group (as in the pipeline's group-by), except the label
    field's receipt date, which the pipeline coerces to a value of its own.
    They go first, so that the joins below compare plain keys and reuse the
    aggregates' partitioning.
    """
    rows, is_l, is_h = _source_rows(label, history, keys, specs)
    for k in keys:
        if k not in _null_safe(specs):
            rows = rows.where(F.col(k).isNotNull())
    plain = [s for s in specs if s.agg not in ("ndistinct", "median")]
    distinct = [s for s in specs if s.agg == "ndistinct"]
    middle = [s for s in specs if s.agg == "median"]
    aggs = [_agg(s, is_l if s.src == "L" else is_h) for s in plain] or [F.count(F.lit(1)).alias("__n")]
    out = rows.groupBy(*keys).agg(*aggs)
    for counts in _distinct_counts(rows, keys, distinct, is_l, is_h):
        out = _join_keys(out, counts, keys, _null_safe(specs))
    if middle:
        out = _join_keys(out, _medians(rows, keys, middle, is_l, is_h), keys, _null_safe(specs))
    out = out.select(*keys, *[F.col(f"`{s.name}`") for s in specs])
    # Groups where no spec found a matching row carry no information (the
    # left join gives null for them anyway).
    keep = F.lit(False)
    for s in specs:
        keep = keep | F.col(f"`{s.name}`").isNotNull()
    return out.where(keep)


def _join_keys(left: DataFrame, right: DataFrame, keys, null_safe_keys=(), how: str = "left") -> DataFrame:
    """Equi-join on ``keys``; keys in ``null_safe_keys`` match null to null."""
    if not any(k in null_safe_keys for k in keys):
        return left.join(right, list(keys), how)
    if how == "full":
        r = right.select(*[F.col(c).alias(f"__k_{c}") if c in keys else F.col(c) for c in right.columns])
        cond = None
        for k in keys:
            c = left[k].eqNullSafe(r[f"__k_{k}"])
            cond = c if cond is None else cond & c
        j = left.join(r, cond, "full")
        return j.select(*[F.coalesce(left[k], r[f"__k_{k}"]).alias(k) for k in keys],
                        *[c for c in left.columns if c not in keys],
                        *[c for c in right.columns if c not in keys])
    r = right.select(*[F.col(c).alias(f"__k_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__k_{k}"]) if k in null_safe_keys else (left[k] == r[f"__k_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__k_{k}" for k in keys])


def _null_safe(block: list[Spec]) -> tuple[str, ...]:
    # The label field's receipt date was coerced (null -> 0) before grouping,
    # so for label-only key sets a null date is a group of its own.
    return (DR,) if all(s.src == "L" for s in block) else ()


def chains(blocks) -> list[tuple[tuple[str, ...], list]]:
    """Assign every key set to a maximal key set containing it.

    The label rows then join once per maximal key set ("chain"); the coarser
    aggregates are first joined onto that chain's key table, which is at most
    as large as the label field and usually much smaller.
    """
    keysets = [k for k, _ in blocks]
    maximal = [k for k in keysets if not any(set(k) < set(o) for o in keysets)]
    maximal.sort(key=len, reverse=True)
    out = {m: [] for m in maximal}
    for k, b in blocks:
        home = next(m for m in maximal if set(k) <= set(m))
        out[home].append((k, b))
    return list(out.items())


def attach(label: DataFrame, history: DataFrame | None, specs: list[Spec], chained: bool = True,
           write_chains: bool = True) -> DataFrame:
    """Left-join every key set's aggregate onto the label rows.

    ``chained=True`` (default): one join of the label rows per maximal key
    set; ``chained=False``: one join per key set (the direct formulation,
    kept for cross-checking).

    ``write_chains``: each chain table is written to the shared checkpoint
    folder and read back, so the planner knows its true size: a table that
    is provably small (e.g. one row per discount rate) is broadcast, a large
    one is sort-merge joined (AQE splits hot keys).  Without it the planner
    only sees an estimate derived from the input and would shuffle the wide
    label rows on a handful of key values before AQE could demote the join.
    """
    blocks = group_blocks(specs)
    out = label
    if not chained:
        for keys, block in blocks:
            out = _join_keys(out, aggregate_block(label, history, keys, block), keys, _null_safe(block))
    else:
        def build(top, members):
            table = label.select(*top).distinct()
            for keys, block in members:
                table = _join_keys(table, aggregate_block(label, history, keys, block), keys,
                                   _null_safe(block))
            return table

        ch = chains(blocks)
        tops = [top for top, _ in ch]
        if write_chains:
            # built and written from one driver thread per chain, so both the
            # plan analysis and the jobs of the chains overlap
            tables = cut_lineage_all([lambda t=t, m=m: build(t, m) for t, m in ch], "chain")
        else:
            tables = [build(t, m) for t, m in ch]
        # every join shuffles what the ones before have attached, so the widest table comes last
        for top, table in sorted(zip(tops, tables), key=lambda x: len(x[1].columns) - len(x[0])):
            # the chain table holds exactly the label rows' key combinations
            # (nulls included), so this join matches null-safe on every key
            out = _join_keys(out, table, top, top)
        out = out.select(*label.columns, *[F.col(f"`{c}`") for top, t in zip(tops, tables) for c in t.columns if c not in top])
    for s in specs:   # first/last receipt flags compare the row with the group value
        if s.agg in ("first", "last"):
            out = out.withColumn(s.name, F.when(F.col(s.value) == F.col(s.name), 1).otherwise(0))
    return out


def _row_feature(name, kind, x, y) -> Column:
    if kind == "guarded":
        return C.guarded_ratio(x, y).alias(name)
    if kind == "plain":
        return C.plain_ratio(x, y).alias(name)
    if kind == "cut":
        return C.cut_price("discount_rate_raw").alias(name)
    raise ValueError(kind)


def label_field_features(label: DataFrame, history: DataFrame, variant: str = "main",
                         weekday_base: int = 1, only: list[str] | None = None) -> DataFrame:
    """The label rows with every feature of ``variant`` attached.

    ``variant`` is ``"main"`` (56 features) or ``"compact"`` (the compact
    variant's subset); with ``only``, just those of its features are built.
    Calendar columns follow: ``week`` (ISO, 1 = Monday, or 0-based with
    ``weekday_base=0``), ``is_weekend`` (week in 5, 6), one-hot ``week_*``
    and ``isnull_Distance``.
    """
    order = [n for n in VARIANTS[variant] if only is None or n in only]
    lab = prepare_label_field(label)
    specs = specs_for(order)
    out = attach(lab, history, specs)
    rows = {n: (n, k, x, y) for n, k, x, y in MAIN_ROW_FEATURES}
    base = label.columns
    sel = [F.col(c) for c in base]
    for n in order:
        sel.append(_row_feature(*rows[n]) if n in rows else F.col(f"`{n}`"))
    out = out.select(*sel)
    return with_calendar(out, weekday_base).withColumn("isnull_Distance", C.null_flag(DIST))


def with_calendar(df: DataFrame, weekday_base: int = 1, prefix: str = "week_") -> DataFrame:
    """Weekday of receipt, weekend flag and one-hot columns."""
    week = C.iso_weekday(DR) if weekday_base == 1 else C.weekday0(DR)
    values = range(1, 8) if weekday_base == 1 else range(0, 7)
    df = df.withColumn("week", week)
    return df.select("*", C.is_weekend("week").alias("is_weekend"), *C.one_hot("week", values, prefix))
