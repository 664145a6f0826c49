"""Session helpers: a tuned local session for tests/bench, and the shared
scratch folder used to cut lineage (written tables, checkpoints)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale; the cluster may override all of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rentscope") -> SparkSession:
    """Local session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         # small local inputs: AQE would coalesce a few-MB shuffle into 2-4
         # partitions (1 MB minimum) and leave cores idle in the CPU-heavy
         # text stages after it; a smaller minimum keeps them parallel
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
         .config("spark.driver.memory", os.environ.get("RENTSCOPE_DRIVER_MEM", "8g")))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001  (no SparkContext on this client, e.g. Spark Connect)
        master = spark.conf.get("spark.master", "")
    return master.startswith("local")


def session_id(spark: SparkSession) -> str:
    """A key for per-session caches."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be configured (a path every executor can reach);
    only a local session gets a private folder when it is unset.  Set at
    most once per context (``setCheckpointDir`` adds a unique sub-folder)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (no SparkContext: use the setting as is)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so written intermediates survive executor loss")
        root = tempfile.mkdtemp(prefix="rentscope-ckpt-")
    if sc is None:
        return root
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/rentscope/{name}-{uuid.uuid4().hex[:12]}"


def spread(df, *keys):
    """Hash-repartition a scan that arrives in fewer partitions than the
    cluster has cores (a dataset stored as one row group is read by one
    task); a well-split input is returned untouched, so at scale this adds
    no shuffle.  Hashing on ``keys`` keeps it deterministic on retry."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()  # planning only, no job
    except Exception:  # noqa: BLE001  (no RDD view on this client: leave it to AQE)
        return df
    if parts >= target:
        return df
    return df.repartition(target, *keys)


def sized_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 << 20,
               max_shuffle_partitions: int = 50_000) -> dict[str, str]:
    """Settings sized to the input for a cluster run.

    Initial shuffle partitions aim at ``target_partition_bytes`` of input
    per partition (never fewer than 2 x cores, capped so the map x reduce
    block count stays manageable); AQE then coalesces small partitions to
    the same advisory size and splits skewed ones (a partition 5x the
    median and above 4x the target) at runtime.  100 TB on 8,000 cores:
    ~400k input splits, 50,000 shuffle partitions."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    parts = min(parts, max(max_shuffle_partitions, 2 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
