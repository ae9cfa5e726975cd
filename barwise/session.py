"""Spark session helpers.

On a cluster the session comes from the launcher and already carries the
cluster's settings; ``configure`` only fills in what is unset so that a
local run (tests, bench) behaves like the cluster: AQE on, UTC, a checkpoint
folder for lineage cuts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings we rely on. AQE re-plans joins from measured shuffle sizes (the
# size check behind every broadcast we do not hint ourselves) and splits
# skewed join partitions; UTC keeps dates identical to the DuckDB oracle.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session has no value, and make sure a
    checkpoint directory exists (cluster value wins; local runs get a
    scratch folder)."""
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session names none on a local master (tests) do we create
    one under the system temp folder; on a cluster a missing setting is an
    error, never a machine-local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="barwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "barwise") -> SparkSession:
    """Session for tests and the local bench (no UI, no server)."""
    scratch = os.environ.get("BARWISE_SCRATCH") or tempfile.mkdtemp(prefix="barwise-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def task_partitions(spark: SparkSession) -> int:
    """Partition count for compute-heavy steps whose inputs are small in
    bytes (weekly chains, backtest folds), where AQE's size-based coalescing
    would leave too few tasks: the session's shuffle-partition setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
