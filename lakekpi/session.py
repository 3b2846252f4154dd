"""Session settings the pipeline relies on, and the shared scratch folder.

All settings are runtime SQL confs, so they can be applied to a session the caller already built.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs for correct results (UTC day boundaries, partition-scoped overwrites).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Rows are held in up to sixteen times their compressed shuffle bytes, several times in a task that sorts, joins and counts:
# with 32 MB, tasks on rows of the large batch stay near 0.6 GB and do not spill, whatever the input.
SHUFFLE_BYTES = 32 * 1024 * 1024

# Settings for scale: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required confs (always) and the scale confs (only where the caller left them unset)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in SCALE_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


ADVISORY_BYTES = 128 * 1024 * 1024


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Initial shuffle partition count for a job reading ``input_bytes``: about two partitions per advisory
    size (128 MB), so no reducer starts oversized; AQE then coalesces small ones.  Only raises the setting."""
    want = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * (input_bytes // ADVISORY_BYTES + 1))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    cur = spark.conf.get(key, None)
    if cur is None or int(cur) < want:
        spark.conf.set(key, str(want))
    return want


def build_session(master: str = "local[*]", app: str = "lakekpi", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """Session for tests, benchmarks and local runs (UI off, Arrow on)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**REQUIRED_CONF, **SCALE_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staging tables and checkpoints: the cluster's ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a machine-local folder is not visible to other executors).
    Only a local-mode session without it (tests, benchmarks) gets a fresh temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="lakekpi-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the scratch folder."""
    base = scratch_dir(spark)
    return os.path.join(base, f"{name}-{os.getpid()}-{next(_counter)}")


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
