"""Session helpers: UTC time zone, AQE, checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"


def get_spark(master: str | None = None, app: str = "ledgerline",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session configured the way the library expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # reliable checkpoints of dropped DataFrames are removed from the shared folder
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


# Settings for the production scale (~100 TB, ~1000 executors).  Shuffle
# partitions start high and AQE coalesces them to ~256 MB; scan splits are
# 256 MB; skewed partitions of sort-merge joins are split by AQE; a join side
# is broadcast only when its runtime size is under 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": UTC,
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_cluster_conf(spark: SparkSession) -> None:
    """Apply :data:`CLUSTER_CONF` (runtime SQL settings) to a session."""
    for k, v in CLUSTER_CONF.items():
        spark.conf.set(k, v)


def use_utc(spark: SparkSession) -> None:
    """Days are UTC days.  Set at the start of every query: the caller owns the session."""
    spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` or a folder already set on the
    context).  Only when neither is set (local tests) a private folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
