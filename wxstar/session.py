"""Session helpers. Library functions never create or configure a session; these are
for tests, scripts and the benchmark, and for finding the shared scratch location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs are designed around (the caller's cluster config may override).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Large scans: fewer, fuller input splits; AQE targets ~256 MB post-shuffle partitions
    # (start spark.sql.shuffle.partitions high on a cluster and let AQE coalesce).
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    # coalesce shuffle partitions to the advisory size rather than to maximum parallelism
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def local_session(
    cores: str = "8", shuffle_partitions: int = 8, app: str = "wxstar", extra_conf: dict | None = None
) -> SparkSession:
    """A local session for tests/benchmarks: UI off, AQE on, UTC."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("WXSTAR_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str = "") -> str:
    """A folder in the cluster's shared checkpoint location (``spark.checkpoint.dir``).

    The session's setting is used as is. Only where it is unset (local tests) a fresh
    temporary folder is created and registered as the checkpoint directory.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no local SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.conf.get("spark.master", "").startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            root = tempfile.mkdtemp(prefix="wxstar-")
        if sc is not None:
            sc.setCheckpointDir(root)  # so DataFrame.checkpoint() writes there too
    root = root.rstrip("/")
    if not name:
        return root
    import uuid

    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
