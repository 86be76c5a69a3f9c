"""Session settings the jobs rely on, and where they put intermediate tables."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for spark-submit on a large cluster. Nothing here is set by library
# code: the submitter owns parallelism, memory and the master.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Start wide; adaptive execution merges partitions up to the advisory size.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Calendar dates follow the session zone, so every job runs in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables written between two steps of a job.

    On a cluster ``spark.checkpoint.dir`` names it, on shared storage. Only a local session
    may leave that unset, and then gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="obsflow-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder, not used by any other step."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staging_folder(spark: SparkSession, owner: str) -> str:
    """The one folder that every run for ``owner`` overwrites."""
    return f"{shared_folder(spark)}/staging-{hashlib.sha256(owner.encode()).hexdigest()[:16]}"
