"""Session construction and cluster-level settings."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every casebook job relies on.  They are applied only when the
# session does not already carry a value, so a cluster's own configuration
# always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "casebook",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, creating one with casebook defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be shared storage;
    it is read from the session and returned unchanged on every call.  Where
    it is unset, a session whose executors run inside the driver process
    (``local[n]``: tests, trials) registers a scratch folder once; any other
    session gets an error, because its executors would not see that folder.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="casebook-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base
