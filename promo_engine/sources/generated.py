"""A generated table of uniform random integers (seeded), with row
labels -- the toy input of the chart exercise.  Not a registered query (it
reads no data); used by tests of the report operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def random_int_table(spark: SparkSession, rows: int = 10, cols=("A", "B", "C", "D", "E"),
                     low: int = 1, high: int = 50, seed: int = 100) -> DataFrame:
    """``rows`` x ``len(cols)`` integers uniform in [low, high), rows named
    ``Row1..RowN``.  Same distribution as the original, not the same bits."""
    base = spark.range(rows)
    return base.select(
        F.concat(F.lit("Row"), (F.col("id") + 1).cast("string")).alias("row"),
        *[(F.floor(F.rand(seed + i) * (high - low)) + low).cast("int").alias(c)
          for i, c in enumerate(cols)])
