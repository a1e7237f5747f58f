"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the cleaning projections alias many CASE expressions; inferring constraints over them
    # costs seconds of optimizer time per query and only adds redundant IS NOT NULL filters
    "spark.sql.constraintPropagation.enabled": "false",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a whole-stage method
    # that large (the wide cleaning projection plus its pushed-down filter) would run
    # interpreted, 2-3x slower than falling back to per-operator code for that subtree
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# suggested additions for a large cluster (~1000 executors, ~100 TB of raw text); sizes keep
# every shuffle partition and every written file in the 128-512 MB range, so tasks fit in
# executor memory (spilling only at the margin) and the file count stays manageable
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",                      # initial; AQE coalesces by size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",   # target shuffle/rebalance partition
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",                 # scan split size
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.autoBroadcastJoinThreshold": "64m",               # Spark's own size check for joins
    "spark.speculation": "true",                                 # slow or lost executors
    "spark.task.maxFailures": "8",
}


def get_spark(master: str | None = None, app: str = "salesmart", shuffle_partitions: int | None = None,
              extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """A session with the library's defaults (``cluster=True`` adds ``CLUSTER_CONF``)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF, **(CLUSTER_CONF if cluster else {}))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a fresh temporary folder (tests); on a
    cluster an unset value is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
    root = tempfile.mkdtemp(prefix="salesmart-ckpt-", dir=os.environ.get("SALESMART_TMP", "/tmp"))
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/salesmart/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    For a derived table read by several branches or actions: without it each would recompute
    the whole chain (branches with differently pruned plans cannot reuse exchanges). A
    reliable checkpoint also survives the loss of the executors that computed it (never
    ``localCheckpoint``).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
