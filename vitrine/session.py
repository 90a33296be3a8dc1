"""Session settings the models rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings. Only the first two are needed for correct values; the rest choose plans.
SQL_CONF = {
    # Landing timestamps are UTC instants; dates are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Malformed casts, overflow and x/0 raise instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where that costs the next operator a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on more than the key an input is partitioned by shuffles it anew, which ``lookup`` relies on.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # A partitioned overwrite replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SQL_CONF`` to a session made elsewhere (a cluster, a notebook, a driver)."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def cluster_conf(shuffled_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition settings for a cluster run that shuffles about ``shuffled_bytes`` in its largest stage.

    Shuffles start with partitions of ``partition_bytes`` and at least two waves over the cores; AQE then
    merges small ones and splits hot ones around the same size. Scans use the same size, so that a task
    sorts its rows in memory before the shuffle.
    """
    partitions = max(2 * cores, -(-shuffled_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vitrine")
        .config("spark.ui.enabled", "false")
        # Call sites are kept for error messages at the price of JVM calls per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="vitrine-warehouse-"))
        # Checkpoints go when nothing reads them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where none is named, a local session takes a scratch folder and a cluster one beside its warehouse; a
    cluster whose warehouse is a local path has no folder all executors reach, and is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="vitrine-checkpoint-")
        else:
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            if warehouse.startswith(("/", "file:")):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = f"{warehouse.rstrip('/')}/_checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder
