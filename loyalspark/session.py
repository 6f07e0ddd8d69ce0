"""Session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on. Applied only when the builder creates
# the session (local runs, tests, bench).
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "loyalspark", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with sane local defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``. Where it is
    unset: an error on a cluster, as a machine's own folder loses data there; a
    scratch folder under a local master, whose only machine shares it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="loyalspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)


# Feature rows are wide: a few MB of compressed shuffle become hundreds in the
# sorts, hash maps and windows of a task. Spark's defaults (64 MB a task after
# the shuffle, 200 partitions whatever the input) make that grow with the input.
_BOUNDED = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_OWN = "spark.loyalspark.initialPartitions"

#: Bytes of input files for each partition of a shuffle.
PARTITION_BYTES = 2 << 20


def bound_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Lets the number of tasks grow with the input, so that no task's memory
    does: a shuffle starts with one partition per ``PARTITION_BYTES`` of input
    files (adaptive execution joins small ones up to 8 MB). Settings that the
    session has stay as they are; ours only ever grows."""
    for k, v in _BOUNDED.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    now, own = spark.conf.get(_INITIAL, None), spark.conf.get(_OWN, None)
    want = -(-input_bytes // PARTITION_BYTES)
    if now == own and want > int(own or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(want))
        spark.conf.set(_OWN, str(want))
