"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splits hot keys.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Settings of Spark's core, which the SQL settings do not list.
CORE_DEFAULTS = {
    "spark.scheduler.mode": "FAIR",  # models of a build that run at once share the cluster
}


# Sizing for a large cluster (~1000 executors, ~100 TB of raw events).
# - Scans: 100 TB / 512 MB splits ~ 200k tasks, a few waves at 8k cores.
# - Shuffles: the largest exchange (order rows by event_id / customer_id,
#   ~20 % of the events) is a few TB; 16k initial partitions keep each
#   reducer near 200-300 MB, and AQE coalesces the small exchanges (the
#   per-check aggregates) down to the advisory size.
# - Broadcast: dimensions up to 64 MB ship to every executor; larger ones
#   sort-merge, with AQE splitting skewed partitions over 1 GB (a customer
#   holding a third of the orders, the NULL keys of guest orders).
CLUSTER_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.parquet.compression.codec": "snappy",
    # state of any stateful query: off-heap RocksDB, changelog checkpoints
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(
    master: str | None = None, app: str = "evstar", cluster: bool = False, **conf: str
) -> SparkSession:
    """Build (or reuse) a session with the package defaults applied.

    On a cluster, leave ``master`` unset so spark-submit decides and pass
    ``cluster=True`` for :data:`CLUSTER_SETTINGS`. Extra ``conf`` entries
    override both.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_DEFAULTS, **CORE_DEFAULTS, **(CLUSTER_SETTINGS if cluster else {}), **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder the cluster shares for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode
    session (tests, local runs) without one gets a fresh temporary folder;
    on a cluster an unset setting is an error, since a machine-local folder
    is not visible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
            local = spark.sparkContext.master.startswith("local")
        except Exception:  # sessions without a local SparkContext
            root, local = None, False
        if not root and not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder on storage shared by the cluster")
    if not root:
        root = tempfile.mkdtemp(prefix="evstar-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root (never reused)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "shared_root", "scratch_dir"]
