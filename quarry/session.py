"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE for runtime coalescing / skew splitting,
# UTC so timestamps never shift, Arrow for the two Python-evaluated steps.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """Local session for tests and the bench. On a cluster use the cluster's session."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    if master.startswith("local") and not master.startswith("local-cluster"):  # a cluster names its own shared folder
        b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quarry-ckpt-"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names this folder (shared storage); it is only set here when
    unset, which happens in local tests.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def materialize(df):
    """Reliable checkpoint of ``df`` into the shared checkpoint folder, computed once.

    ``Dataset.checkpoint`` runs one job to compute and a second to write the
    files; persisting first makes the second job read the cached blocks
    instead of recomputing the plan. The cache is dropped once the files exist."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
