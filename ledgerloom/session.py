"""Session construction and the shared scratch folder.

Scratch data (written tables, checkpoints) always lives under the folder the
cluster names in ``spark.checkpoint.dir``: a path every executor can read, so a
lost executor never takes intermediate results with it.  A private local folder
is created only when the setting is missing *and* Spark runs in local mode
(tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets.  AQE re-plans joins and partition counts from
# measured shuffle sizes and splits skewed join partitions at run time.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from plan estimates: a Parquet side can be tiny on disk
    # (dictionary-encoded, compressed) and far larger in memory.  Broadcasts
    # come from AQE's measured shuffle sizes or from an exact size check
    # (``operators.layout.broadcast_if_small``).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # Spark 4 refuses charsets outside the UTF/ASCII/Latin-1 set unless this is on;
    # the ledger files are windows-1251.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerloom",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied.

    With ``input_bytes`` and ``total_cores`` (the expected input size and the
    cluster's cores), split and shuffle sizes come from ``recommended_conf``;
    ``shuffle_partitions`` and ``extra_conf`` override them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if input_bytes and total_cores:
        conf.update(recommended_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if (master or "").startswith("local"):
        # local runs: keep Spark's default catalog folder out of the working directory
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="ledgerloom-warehouse-")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def enable_legacy_charsets(spark: SparkSession) -> None:
    """Allow Java charsets such as windows-1251 in the CSV reader/writer (runtime conf)."""
    if spark.conf.get("spark.sql.legacy.javaCharsets", "false").lower() != "true":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for scratch tables: ``spark.checkpoint.dir``.

    Falls back to a fresh local folder only in local mode, where one machine is
    the whole cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    root = tempfile.mkdtemp(prefix="ledgerloom-shared-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable: reuse the cluster's folder, set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = shared_root(spark)
    sc.setCheckpointDir(f"{root}/rdd-checkpoints")
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused path under the shared root for one written table."""
    return f"{shared_root(spark)}/ledgerloom/{label}-{uuid.uuid4().hex[:16]}"


# Target sizes for sizing a job to its data: big enough that per-task overhead
# is small, small enough that a task's working set fits executor memory
# without heavy spilling.
SCAN_SPLIT_BYTES = 256 * 1024 * 1024
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
BUCKET_FILE_BYTES = 512 * 1024 * 1024


def recommended_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.5) -> dict[str, str]:
    """Settings for a job reading ``input_bytes`` on ``total_cores`` cores.

    * scan splits of 256 MB;
    * enough shuffle partitions for ~256 MB each of the expected shuffle volume
      (``shuffle_fraction`` of the input, after pruning and filters), never
      fewer than 3 waves of tasks; AQE coalesces small ones at run time;
    * AQE's advisory size and skew threshold tied to the same target, so a
      partition several times the target is split, not spilled.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = max(3 * total_cores, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * SHUFFLE_PARTITION_BYTES),
    }


# Spark refuses tables of more than 100,000 buckets; the largest power of two below
# that.  Beyond 32 TB the bucket files grow instead.
MOST_BUCKETS = 1 << 16


def suggested_buckets(table_bytes: int) -> int:
    """Bucket count for a keyed table: ~512 MB per bucket file, a power of two Spark accepts."""
    target = max(1, -(-table_bytes // BUCKET_FILE_BYTES))
    return min(MOST_BUCKETS, 1 << (target - 1).bit_length())


def buckets_for(spark: SparkSession, table_bytes: int) -> int:
    """Buckets for a table of that size on this cluster: sized files, but at least one per core."""
    return max(suggested_buckets(table_bytes), min(MOST_BUCKETS, spark.sparkContext.defaultParallelism))


def partitions_for(spark: SparkSession, input_bytes: int) -> int:
    """Partitions for a repartition of that input: ~256 MB each, but at least one per core."""
    return max(-(-input_bytes // SHUFFLE_PARTITION_BYTES), spark.sparkContext.defaultParallelism)
