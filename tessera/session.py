"""Session helpers: a tuned SparkSession and a reliable checkpoint directory."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    ``spark.sql.shuffle.partitions`` is left as the cluster set it unless a number is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, reading ``spark.checkpoint.dir`` first.

    A directory is only invented for local-mode sessions (tests); on a cluster the shared
    folder must be configured, because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running tessera jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def table(spark: SparkSession, sf_dir: str, name: str):
    """Load one of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


NARROW = {"Project", "Filter", "Generate", "LogicalRelation", "Relation", "LogicalRDD", "LocalRelation", "Range"}


def _narrow(df) -> bool:
    """True if the plan is a scan with projections and filters only, so that counting its
    partitions runs no upstream stage."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while True:
        if plan.nodeName() not in NARROW:
            return False
        children = plan.children()
        if children.size() != 1:
            return children.size() == 0
        plan = children.apply(0)


def spread(df, min_partitions: int | None = None):
    """Round-robin the rows over at least ``min_partitions`` (default: the cluster's cores) when
    a plain scan yields fewer partitions, so CPU-heavy row work is not stuck in a few scan tasks.
    Large inputs already scan in many splits and pass through unchanged (no extra shuffle); so does
    anything behind a shuffle, whose partitions are not counted, since that would run it."""
    if df.isStreaming or not _narrow(df):  # a micro-batch's partitioning is decided by the source
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
