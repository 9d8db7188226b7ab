"""Session construction and the few session-level settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job expects. AQE re-plans joins and coalesces shuffle
# partitions at runtime; the skew-join split handles a hot key on the big
# side of a shuffle join (one agent or account holding a large share of deals).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # drop the ranking checkpoints once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerline", extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when nothing is configured and the master is local (a bare test
    session) a private folder is created, so ``DataFrame.checkpoint`` can run;
    on a cluster a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception as exc:  # a Spark Connect session: only the configuration can be read
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share") from exc
        return found
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the application ends (until then lazily built results may read it)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
