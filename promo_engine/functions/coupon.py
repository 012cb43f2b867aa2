"""Scalar column expressions for coupon logs.

Every function takes and returns ``Column`` objects so the expressions stay
inside whole-stage codegen.  Null handling follows the pandas pipeline that
defines the semantics: a missing discount is "not a threshold coupon", a
comparison against a missing date is false, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the semantics (must stay equal to the pipeline
# being rebuilt): the redemption horizon in days, the discount cut-off of the
# report label, the weekend weekday numbers and the null-distance sentinel.
REDEEM_WITHIN_DAYS = 15
CHEAP_DISCOUNT_MAX = 0.8
WEEKEND_VALUES = (5, 6)
NULL_DISTANCE = -1


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_threshold(raw) -> Column:
    """1 when the discount text is ``"x:y"`` (spend x, get y off), else 0."""
    return F.when(F.coalesce(F.instr(_c(raw), ":") > 0, F.lit(False)), 1).otherwise(0)


def _part(raw, i: int) -> Column:
    return F.split_part(_c(raw), F.lit(":"), F.lit(i))


def threshold_amount(raw) -> Column:
    """The x of ``"x:y"`` as double (null for plain rates)."""
    return _part(raw, 1).try_cast("double")


def threshold_cut(raw) -> Column:
    """The y of ``"x:y"`` as double (null for plain rates)."""
    return _part(raw, 2).try_cast("double")


def discount_rate(raw) -> Column:
    """``"x:y"`` -> (x - y) / x; ``"0.9"`` -> 0.9; null -> null."""
    x, y = threshold_amount(raw), threshold_cut(raw)
    return (F.when(is_threshold(raw) == 1, F.try_divide(x - y, x))
            .otherwise(_c(raw).try_cast("double")))


def discount_rate_rounded(raw, digits: int = 5) -> Column:
    """Discount rate rounded half-to-even (Python ``round``)."""
    return F.bround(discount_rate(raw), digits)


def min_cost(raw) -> Column:
    """C4: integer x of ``"x:y"``; -1 for plain rates and null."""
    return (F.when(is_threshold(raw) == 1, _part(raw, 1).try_cast("int"))
            .otherwise(F.lit(-1)))


def cut_price(raw) -> Column:
    """Y of ``"x:y"`` as double; 0 otherwise."""
    return F.when(is_threshold(raw) == 1, threshold_cut(raw)).otherwise(F.lit(0.0))


def distance_filled(d) -> Column:
    """Null distance -> -1."""
    return F.coalesce(_c(d).cast("int"), F.lit(NULL_DISTANCE))


def null_flag(filled_distance) -> Column:
    """1 when the (filled) distance is the -1 sentinel."""
    return F.when(_c(filled_distance) == NULL_DISTANCE, 1).otherwise(0)


def yyyymmdd_to_date(c) -> Column:
    """Numeric or text yyyymmdd (possibly ``20160516.0``) -> date."""
    as_text = _c(c).try_cast("double").try_cast("bigint").cast("string")
    return F.try_to_date(as_text, "yyyyMMdd")


def day_gap(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` (null if either is null)."""
    return F.datediff(_c(later), _c(earlier))


def label_15d(date_used, date_received) -> Column:
    """1 when used at most 15 days after receipt (a negative gap counts);
    never used or no receipt -> 0."""
    return F.when(F.coalesce(day_gap(date_used, date_received) <= REDEEM_WITHIN_DAYS,
                             F.lit(False)), 1).otherwise(0)


def cheap_label(rate) -> Column:
    """1 when the discount rate is at most 0.8 (null -> 0)."""
    return F.when(F.coalesce(_c(rate) <= CHEAP_DISCOUNT_MAX, F.lit(False)), 1).otherwise(0)


def iso_weekday(d) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(_c(d)) + 1


def weekday0(d) -> Column:
    """C14: Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def is_weekend(week) -> Column:
    """1 when ``week`` is 5 or 6 (Fri/Sat on ISO numbers, Sat/Sun 0-based)."""
    return F.when(_c(week).isin(*WEEKEND_VALUES), 1).otherwise(0)


def one_hot(week, values, prefix: str = "week_") -> list[Column]:
    """C17: fixed list of 0/1 columns, one per value.  A null week gives 0s."""
    return [F.when(_c(week) == v, 1).otherwise(0).alias(f"{prefix}{v}") for v in values]


def guarded_ratio(x, y) -> Column:
    """X / y, 0 when y == 0, null when either side is null."""
    return (F.when(_c(y).isNull() | _c(x).isNull(), F.lit(None).cast("double"))
            .when(_c(y) == 0, F.lit(0.0))
            .otherwise(_c(x).cast("double") / _c(y).cast("double")))


def plain_ratio(x, y) -> Column:
    """X / y with no guard; y == 0 gives null (never raises)."""
    return F.try_divide(_c(x).cast("double"), _c(y).cast("double"))


def zero_for_missing_distance(d) -> Column:
    """C20: -1 -> 0, other distances unchanged."""
    return F.when(_c(d) == NULL_DISTANCE, 0).otherwise(_c(d))


def stable_mean(x) -> Column:
    """Mean of doubles that does not depend on summation order.

    Sums in decimal(38, 18), which keeps 18 decimals, and divides once at the
    end.  Groups with a magnitude of 1e15 or more, and groups whose sum leaves
    that range all the same, use the plain double mean.
    """
    xc = _c(x).cast("double")
    exact = F.try_sum(xc.try_cast("decimal(38,18)")).cast("double")
    mean = F.coalesce(F.try_divide(exact, F.count(xc).cast("double")), F.avg(xc))
    return F.when(F.max(F.abs(xc)) < 1e15, mean).otherwise(F.avg(xc))
