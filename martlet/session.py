"""SparkSession construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone is pinned so that naive ISO strings
# and `X`-patterned UTC stamps parse the same on every executor.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files in the shared folder are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "martlet", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    On a cluster, leave ``master`` unset and let spark-submit decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces it down).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back a running session: re-assert runtime SQL confs.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and not k.startswith("spark.sql.warehouse"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a live session
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared file system and an
    unset value is an error. Only in local mode (local runs, tests) do we
    create a private one when it is unset.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder every executor "
                "shares (HDFS, S3, ...); a machine-local folder does not survive on a cluster")
        d = tempfile.mkdtemp(prefix="martlet-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for materialised tables."""
    return os.path.join(checkpoint_dir(spark), name)
