"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # iterative operators run many small queries; keep the driver's record
    # of finished executions and their plan text bounded
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.sql.maxPlanStringLength": "200000",
}


def get_spark(master: str | None = None, app: str = "lodestar",
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only a local master, whose tasks all run in the driver's own
    process, gets a scratch folder when it is unset; on a cluster every
    executor would write to a disk of its own, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="lodestar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
