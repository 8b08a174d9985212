"""Session defaults and the shared working folder.

The library never creates its own session in library code: callers pass one.
``configure`` only fills in settings that are unset, so a cluster's own
configuration always wins.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins from runtime sizes (broadcast
# conversion is size-checked by the engine), coalesces small shuffle
# partitions and splits skewed sort-merge join partitions. Partitions are joined up to 16 MB of
# shuffled bytes (Spark: 64 MB), which sorts and aggregates hold some tenfold in memory.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``DEFAULTS`` where the session has no value yet, and put this package's folder on the
    Python path of the workers (a checkout need not be installed, nor be the working folder)."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


INITIAL, OURS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "riskbook.initialPartitionNum"
INPUT_BYTES = 16 << 20


def spread(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles start with a partition for every ``INPUT_BYTES`` of input where that is more than the session's number of
    shuffle partitions, so that a task's share stays the same however large the input; AQE joins those that hold little.
    A number that the cluster has set itself stays."""
    have, ours = spark.conf.get(INITIAL, None), spark.conf.get(OURS, None)
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(ours or 0))
    if have == ours and input_bytes // INPUT_BYTES > least:
        spark.conf.set(INITIAL, str(input_bytes // INPUT_BYTES))
        spark.conf.set(OURS, str(input_bytes // INPUT_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system every
    executor can reach). Only in local mode without one (tests) a fresh
    folder is created and registered; on a cluster a missing setting is an
    error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if current != sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not (sc.master or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="riskbook-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)  # tests only: nothing outlives the process
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path below :func:`shared_dir` for one intermediate table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "riskbook") -> SparkSession:
    """Session for tests and the bench: local mode, UI off, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKBOOK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
