"""Written intermediate tables in the shared checkpoint folder.

A dataset needs the history and the label field many times (one aggregate
per key set plus the join base).  Instead of re-deriving them from the raw
logs for every branch of the plan, one job tags each cleaned row with the
field it belongs to and writes the result as parquet partitioned by field;
every branch then reads only its field (partition pruning) and its columns
(column pruning).  The written table also cuts the lineage: a lost executor
re-reads files instead of recomputing the source join.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promo_engine.plans import split as SP
from promo_engine.session import scratch_path

_WRITTEN: dict[tuple, str] = {}
_LOCK = threading.Lock()   # one writer per table when builders run in threads


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _identity(spark: SparkSession, df: DataFrame) -> tuple:
    """What ``df`` reads: its plan, and each input file's size and modification time."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for f in sorted(df.inputFiles()):
        p = jvm.org.apache.hadoop.fs.Path(f)
        s = p.getFileSystem(conf).getFileStatus(p)
        files.append((f, s.getLen(), s.getModificationTime()))
    return df.semanticHash(), tuple(files)


def file_state(spark: SparkSession, paths) -> tuple:
    """Size and modification time of every file under ``paths``, without reading or planning anything."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        files = p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            s = files.next()
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def received_range(splits) -> tuple:
    """Smallest [lo, hi) receipt-date range covering every history and label
    interval of ``splits`` (used to prune the source before tagging)."""
    ivs = [iv for s in splits for iv in (s.history, s.label) if iv is not None]
    return min(iv.start for iv in ivs), max(iv.end for iv in ivs)


def fields_table(spark: SparkSession, cleaned, splits, token: str, sources=None) -> DataFrame:
    """(cleaned columns..., split, field) for the history and label intervals
    of every split set in ``splits``, written in ONE pass over the source
    (a row is repeated once per interval it falls in) and partitioned by
    split and field.  Written once per session, source ``token`` and state
    of the input: other rows or replaced files are written anew.  That state is
    the plan and files of ``cleaned`` (``_identity``); with ``sources``, the
    paths which it reads, it is that of their files, and ``cleaned`` may be a
    function that is only called when the table has to be written."""
    splits = tuple(splits)
    state = _identity(spark, cleaned) if sources is None else file_state(spark, sources)
    key = (spark.sparkContext.applicationId, token, splits, state)
    with _LOCK:
        return spark.read.parquet(_write_once(spark, cleaned, splits, key))


def _write_once(spark: SparkSession, cleaned, splits, key) -> str:
    path = _WRITTEN.get(key)
    if path is not None and not _exists(spark, f"{path}/_SUCCESS"):
        path = None   # the folder was cleaned up: write again
    if path is None:
        digest = hashlib.sha1(repr(key).encode()).hexdigest()[:16]
        path = scratch_path(spark, f"fields-{digest}")
        tags = []
        for s in splits:
            tags.append(F.when(s.history.predicate(), F.lit(f"{s.name}/history")))
            if s.label is not None:
                tags.append(F.when(s.label.predicate(), F.lit(f"{s.name}/label")))
        tag = F.explode(F.array_compact(F.array(*tags)))
        cleaned = cleaned() if callable(cleaned) else cleaned
        (cleaned.select("*", tag.alias("__tag"))
         .withColumn("split", F.split_part("__tag", F.lit("/"), F.lit(1)))
         .withColumn("field", F.split_part("__tag", F.lit("/"), F.lit(2)))
         .drop("__tag")
         .write.mode("overwrite").partitionBy("split", "field").parquet(path))
        _WRITTEN[key] = path
    return path


def fields(spark: SparkSession, cleaned, split: SP.SplitSet, token: str, test_table: DataFrame | None = None,
           family=None, sources=None) -> tuple[DataFrame, DataFrame]:
    """(history, label) of ``split`` read back from the written table of its
    split family (partition pruning on split and field)."""
    t = fields_table(spark, cleaned, family or (split,), token, sources)
    mine = t.where(F.col("split") == split.name).drop("split")
    history = mine.where(F.col("field") == "history").drop("field")
    if split.label is None:
        label = SP.label_field(cleaned() if callable(cleaned) and test_table is None else cleaned, split, test_table)
    else:
        rows = mine.where(F.col("field") == "label").drop("field")
        label = SP.label_field(rows, SP.SplitSet(split.name, split.history, None, None, split.has_outcome),
                               rows)
    return history, label
