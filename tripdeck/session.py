"""Session helpers: building a session for local runs and finding shared scratch space.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a shared folder
(HDFS, S3, ...). Everything this library writes as intermediate state goes below that folder;
a local default is set only when the setting is missing, as in tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings that matter at scale; all of them are standard Spark SQL options.
SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed join partitions,
    # turn sort-merge joins into broadcast joins when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Planner-side broadcast only below a size Catalyst can prove from statistics.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # All trip timestamps are TIMESTAMP_NTZ; keep anything zone-dependent pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "tripdeck",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster job uses the session it is given."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is a cluster)."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Where the session names none, a local folder is set
    on a local master; on a cluster, whose nodes would each write to their own disk, it raises."""
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not is_local(spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all nodes share")
        current = tempfile.mkdtemp(prefix="tripdeck-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder (never reused, never cleared)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tripdeck/{name}-{uuid.uuid4().hex[:12]}"
