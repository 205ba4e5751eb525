"""Session helpers.

The library never creates a session on its own: every job function takes the
caller's ``SparkSession``. ``ensure_utc`` pins the only setting the semantics
depend on (hour buckets and UTC dates). ``local_session`` is what tests and
``bench.py`` use; on a cluster the submitter configures the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Hour truncation and dates are defined in UTC (reading hours are UTC)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "haze") -> SparkSession:
    """A local session configured the way the jobs expect to run."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("HAZE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="haze-warehouse-"))
        # delete checkpoint files once their DataFrame is garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return ensure_utc(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage and we only read it
    (unset on a cluster is an error: a machine-local folder would not be seen
    by the other executors). When it is unset in local mode (tests) a fresh
    private folder is created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            current = tempfile.mkdtemp(prefix="haze-ckpt-")  # local mode only
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for ``input_bytes`` of input.

    Initial shuffle partitions are sized so that one partition holds about
    ``partition_bytes`` of input (AQE then merges small ones and splits skewed
    join partitions); file splits use the same size. For 100 TB this gives
    ~400k partitions; at least 200.
    """
    parts = max(200, input_bytes // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20) -> None:
    for key, value in scale_settings(input_bytes, partition_bytes).items():
        spark.conf.set(key, value)
