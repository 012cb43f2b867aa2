"""Session helpers: building a local session for tests/bench and resolving the
shared checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  On a cluster they are normally given by the
# submitter; ``configure`` only fills in what is missing.
DEFAULT_CONF = {
    # Feature plans join ~10 aggregates onto wide rows; inferring null
    # constraints across them dominates optimisation time and adds nothing
    # for left joins.
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "promo_engine") -> SparkSession:
    """Local session for tests and the benchmark (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PROMO_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``DEFAULT_CONF`` for settings not given explicitly at launch;
    never override what the cluster submitter set."""
    launch = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if not launch.contains(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set (a shared filesystem every executor
    can reach).  Only when it is unset -- local tests -- a private folder under
    the system temp dir is created and registered.
    """
    sc = spark.sparkContext
    cur = sc._jsc.sc().getCheckpointDir()
    if cur.isDefined():
        return cur.get()
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="promo-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame, name: str = "cut", **options: str) -> DataFrame:
    """Write ``df`` as a parquet table (with the writer's ``options``) in the
    shared checkpoint folder and read it back.

    Truncates the plan before iterative stages (model fit, Lloyd passes,
    choice of k) and survives executor loss (files, not executor memory).
    Unlike ``DataFrame.checkpoint(eager=True)``, which runs the plan once to
    count and again to write, the plan runs exactly once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)


def cut_lineage_all(dfs: list, name: str = "cut") -> list[DataFrame]:
    """``cut_lineage`` for several independent frames (or zero-argument
    builders of frames), written by concurrent jobs -- one driver thread
    each -- so their stages share the executors."""
    from concurrent.futures import ThreadPoolExecutor

    def one(d):
        return cut_lineage(d() if callable(d) else d, name)

    if len(dfs) <= 1:
        return [one(d) for d in dfs]
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(one, dfs))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
