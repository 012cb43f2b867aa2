"""File readers for the original inputs.

The offline coupon logs are CSV with a header; ids and dates are read as
text and cast explicitly (a float-looking id such as ``7.0`` would silently
become null under a numeric schema).  ``null`` and empty fields are missing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promo_engine.functions import coupon as C

OFFLINE_COLUMNS = ("User_id", "Merchant_id", "Coupon_id", "Discount_rate", "Distance",
                   "Date_received", "Date")


def bad_values(spark: SparkSession, path: str) -> DataFrame:
    """``column_name, n_bad, example``: values of an offline log that its
    numeric and date columns can't hold (P11), for columns that have any."""
    df = spark.read.option("header", True).option("nullValue", "null").csv(path)
    checks = {c: F.col(c).try_cast("double").try_cast("bigint") for c in ("User_id", "Merchant_id", "Coupon_id", "Distance")}
    checks |= {c: C.yyyymmdd_to_date(c) for c in ("Date_received", "Date") if c in df.columns}
    found = F.array(*[F.when(F.col(c).isNotNull() & v.isNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")))
                      for c, v in checks.items()])
    return (df.select(F.explode(F.array_compact(found)).alias("b")).groupBy("b.column_name")
            .agg(F.count(F.lit(1)).alias("n_bad"), F.min("b.v").alias("example")))


def read_offline_csv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Offline coupon log (train has ``Date``, test does not) mapped to
    the canonical raw coupon schema of ``sources.coupons``.  Bad ids and dates
    become null; ``bad_values`` counts them, and ``strict`` raises on any."""
    if strict:
        bad = bad_values(spark, path).collect()               # a row per column at most
        if bad:
            raise ValueError("bad values: " + "; ".join(f"{r['column_name']} {r['n_bad']}, such as {r['example']!r}"
                                                        for r in sorted(bad, key=lambda r: r["column_name"])))
    head = spark.read.option("header", True).option("nullValue", "null").csv(path)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in head.columns])
    df = spark.read.option("header", True).option("nullValue", "null").schema(schema).csv(path)
    cols = df.columns

    def num(c):
        return F.col(c).try_cast("double").try_cast("bigint")

    return df.select(
        num("User_id").alias("user_id"),
        num("Merchant_id").alias("merchant_id"),
        num("Coupon_id").alias("coupon_id"),
        F.col("Discount_rate").alias("discount_rate_raw"),
        num("Distance").alias("distance_raw"),
        C.yyyymmdd_to_date("Date_received").alias("date_received"),
        (C.yyyymmdd_to_date("Date") if "Date" in cols else F.lit(None).cast("date")).alias("date_used"),
    )


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """S1 with quarantine: the rows of ``read_offline_csv`` with ``reason``
    and ``line``.  ``reason`` is null in good rows; else it names, in the
    order of the columns, every value that its column can't hold (null in
    the row), or says that the line has too few or too many fields, and
    ``line`` is then the text of the line.  No line is lost: the good rows
    are those without a reason, the rest can be written elsewhere."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    first = lines.first()
    head = (first["value"] if first else ",".join(OFFLINE_COLUMNS)).strip().split(",")
    # a field that isn't there is null, one that is there and empty is not
    schema = ", ".join(f"`{c}` string" for c in (*head, "_more"))
    fields = F.from_csv("value", schema, {"nullValue": "\u0001"})
    df = lines.where(F.trim("value") != ",".join(head)).select("value", fields.alias("f")).select("value", "f.*")
    whole = F.col(head[-1]).isNotNull() & F.col("_more").isNull()
    df = df.select("value", whole.alias("_whole"), *[
        F.when(F.trim(c) != "null", F.nullif(F.trim(c), F.lit(""))).alias(c) for c in head])
    number = {c: F.col(c).try_cast("double").try_cast("bigint") for c in ("User_id", "Merchant_id", "Coupon_id", "Distance")}
    date = {c: C.yyyymmdd_to_date(c) for c in ("Date_received", "Date") if c in head}
    bad = [F.when(F.col(c).isNotNull() & v.isNull(), F.concat(F.lit(f"{c}: "), F.col(c)))
           for c, v in sorted((number | date).items(), key=lambda x: head.index(x[0]))]
    reason = F.when(~F.col("_whole"), F.lit("wrong number of fields")).otherwise(
        F.nullif(F.concat_ws("; ", *bad), F.lit("")))
    return df.select(number["User_id"].alias("user_id"), number["Merchant_id"].alias("merchant_id"),
                     number["Coupon_id"].alias("coupon_id"), F.col("Discount_rate").alias("discount_rate_raw"),
                     number["Distance"].alias("distance_raw"), date["Date_received"].alias("date_received"),
                     date.get("Date", F.lit(None).cast("date")).alias("date_used"), reason.alias("reason"),
                     F.when(reason.isNotNull(), F.col("value")).alias("line"))


def read_headerless_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV without header; columns come out as ``_c0.._cN`` (text)."""
    return spark.read.option("header", False).csv(path)


def read_whitespace_text(spark: SparkSession, path: str) -> DataFrame:
    """S3: numbers separated by runs of whitespace (the CSV reader has no
    regex separator): one text line -> split -> ``_c0.._cN`` doubles.  There
    are as many columns as the longest line has tokens; shorter lines end in
    nulls."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parts = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+")
    n = lines.agg(F.coalesce(F.max(F.size(parts)), F.lit(0)).alias("n")).first()["n"]
    return lines.select(*[F.get(parts, F.lit(i)).try_cast("double").alias(f"_c{i}") for i in range(n)])


@dataclass(frozen=True)
class DatasetSpec:
    """S5 registry entry: how to read one clustering dataset."""
    reader: str                       # "csv", "csv_header", "whitespace"
    drop_last: bool = False           # P6: a trailing class column
    drop: tuple[str, ...] = ()        # S4: named columns to drop
    recode: dict = field(default_factory=dict)   # P18: value -> code


# The clustering datasets and their per-dataset cleaning.
DATASETS = {
    "iris": DatasetSpec("csv", drop_last=True),
    "abalone": DatasetSpec("csv", recode={"M": 0, "I": 1, "F": 2}),
    "seeds": DatasetSpec("whitespace"),
    "wine": DatasetSpec("csv"),
    "wholesale": DatasetSpec("csv_header", drop=("Channel", "Region")),
}


def load_dataset(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read a registered clustering dataset as numeric columns plus a
    row id (``id``), ready for ``cluster.pca_2d``."""
    spec = DATASETS[name]
    if spec.reader == "whitespace":
        df = read_whitespace_text(spark, path)
    elif spec.reader == "csv_header":
        df = spark.read.option("header", True).csv(path).drop(*spec.drop)
    else:
        df = read_headerless_csv(spark, path)
        if spec.drop_last:
            df = df.select(df.columns[:-1])
    if spec.recode:
        df = df.replace({k: str(v) for k, v in spec.recode.items()})
    cols = df.columns
    return df.select(F.monotonically_increasing_id().alias("id"),
                     F.array(*[F.col(f"`{c}`").try_cast("double") for c in cols]).alias("p"))
