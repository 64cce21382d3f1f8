"""SparkSession construction and cluster-shared scratch locations.

Every setting here is a plain Spark configuration key.  On a cluster the
session is usually created by the platform; `configure()` only fills in keys
that are unset so that cluster-wide choices (shuffle partitions, checkpoint
directory, broadcast threshold) win.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on for result fidelity (UTC, ANSI) and for
# runtime re-planning (AQE, skew splitting).  Sizes are defaults for local
# runs; a cluster deployment sets its own values and they are kept.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcast only relations of a small *measured* size.  The threshold for
    # AQE's own demotions stays unset, so that it follows this one (or the
    # cluster's): a laxer one would let the driver collect more than it can hold.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches for Python tasks are bounded in bytes too: a thousand long texts are no small batch.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply library defaults to keys the session has not set itself."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # The session time zone decides how timestamps print and how
    # timestamp <-> date casts behave; results are specified in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    *and* the master is local (tests, single-machine runs) a private
    directory is created; on a cluster an unset directory is an error,
    because a machine-local folder is not visible to every executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared filesystem path (e.g. on HDFS or object storage)")
    local = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local
