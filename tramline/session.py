"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution re-plans at run time with measured sizes: it merges small shuffle
# partitions, splits skewed join partitions, and broadcasts or hashes a side instead of sorting
# both only if that side turned out small.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

PARTITION_BYTES = 128 << 20


def cluster_conf(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run on many machines.

    `shuffled_bytes` is the largest shuffle expected, which for enrichment is about the size of
    the positions. Partitions start small enough to fit an executor core's memory; adaptive
    execution merges them where less data arrives. Decommissioned executors hand on their
    shuffle files, and lost ones are recomputed from their inputs.
    """
    partitions = max(3 * cores, -(-shuffled_bytes // PARTITION_BYTES))
    return SESSION_CONF | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * PARTITION_BYTES),
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
    }


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tramline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    """One temporary folder per process, gone with it."""
    folder = tempfile.mkdtemp(prefix="tramline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    It lies in the folder the cluster names in `spark.checkpoint.dir`, which the cluster empties.
    A temporary folder of this machine is used only in local mode, where there are no other
    machines, and removed when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_scratch()
    return f"{shared.rstrip('/')}/tramline/{purpose}-{uuid.uuid4().hex}"
