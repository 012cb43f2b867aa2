"""M1: time split of the cleaned coupon rows into history / middle / label
intervals.  Every interval is a half-open date range, so the filter is a
plain range predicate that Catalyst pushes into a (date-partitioned) scan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Interval:
    start: dt.date
    days: int
    column: str = "date_received"

    @property
    def end(self) -> dt.date:
        return self.start + dt.timedelta(days=self.days)

    def predicate(self) -> Column:
        c = F.col(self.column)
        return (c >= F.lit(self.start)) & (c < F.lit(self.end))


@dataclass(frozen=True)
class SplitSet:
    """One dataset to build: history interval, optional middle interval
    (on ``date_used``), and the label interval.  ``label=None`` means the
    whole (separate) test table is the label field."""
    name: str
    history: Interval
    label: Interval | None
    middle: Interval | None = None
    has_outcome: bool = True


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _set(name, h_start, h_days, l_start, l_days, has_outcome=True):
    h = Interval(_d(h_start), h_days)
    lab = Interval(_d(l_start), l_days) if l_start else None
    mid = None
    if lab is not None:
        mid = Interval(h.end, (lab.start - h.end).days, "date_used")
    return SplitSet(name, h, lab, mid, has_outcome)


# The reference windows on the original 2016 coupon logs.
MAIN_SPLITS = (
    _set("train", "2016-03-02", 60, "2016-05-16", 31),
    _set("validate", "2016-01-16", 60, "2016-03-31", 31),
    _set("test", "2016-04-17", 60, None, 0, has_outcome=False),
)
COMPACT_SPLITS = (
    _set("train", "2016-01-01", 30, "2016-04-01", 30),
    _set("test", "2016-05-01", 30, None, 0, has_outcome=False),
)

# Windows for the driver tables (orders span 1995-01-01 .. 2001-08-01): a
# 360-day history and a 180-day label interval two weeks later; validation one
# year earlier, test one and a half years later (outcome hidden).
ADAPTER_SPLITS = (
    _set("train", "1998-01-01", 360, "1999-01-10", 180),
    _set("validate", "1997-01-01", 360, "1998-01-10", 180),
    _set("test", "1999-07-01", 360, "2000-07-09", 180, has_outcome=False),
)


def history_field(cleaned: DataFrame, split: SplitSet) -> DataFrame:
    return cleaned.where(split.history.predicate())


def middle_field(cleaned: DataFrame, split: SplitSet) -> DataFrame | None:
    return None if split.middle is None else cleaned.where(split.middle.predicate())


def label_field(cleaned: DataFrame, split: SplitSet, test_table: DataFrame | None = None) -> DataFrame:
    """Label rows.  For a test set the outcome (``date_used``, ``label``) is
    removed -- it is what the model has to predict."""
    if split.label is None:
        if test_table is None:
            raise ValueError(f"split {split.name!r} needs the test table")
        rows = test_table
    else:
        rows = cleaned.where(split.label.predicate())
    if not split.has_outcome:
        rows = rows.withColumn("date_used", F.lit(None).cast("date"))
        if "label" in rows.columns:
            rows = rows.drop("label")
    return rows


def split_fields(cleaned: DataFrame, split: SplitSet, test_table: DataFrame | None = None):
    return (history_field(cleaned, split), middle_field(cleaned, split),
            label_field(cleaned, split, test_table))
