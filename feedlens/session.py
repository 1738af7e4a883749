"""Session construction and the shared scratch location.

Jobs that must cut lineage or round-trip data through files write under the
folder named by ``spark.checkpoint.dir``.  On a cluster that setting points at
shared storage; we only set our own value when the session has none (local
runs and tests).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "feedlens") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Settings sized from the input for a cluster run.

    Shuffle partitions hold about ``target_partition_bytes`` each (and are
    never fewer than twice the cores), file splits use the same target, AQE
    coalesces small partitions and splits skewed join partitions.
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        # Streaming dedupe state (every review id inside the watermark) is
        # kept in RocksDB: off-heap and on local disk, checkpointed to the
        # shared folder, so it does not have to fit in executor heaps.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def ensure_utc(spark: SparkSession) -> None:
    """Review dates are UTC instants; keep the session clock in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables."""
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # Unset: local runs and tests only.  A cluster names a shared folder.
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"{_CHECKPOINT_KEY} must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="feedlens-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set(_CHECKPOINT_KEY, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/feedlens/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedlens`` importable in Python workers (once per context).

    Python-side operators (``mapInPandas``) unpickle functions of this
    package on the executors.  The package is zipped in memory, written
    through the Hadoop file system of the shared checkpoint folder (HDFS,
    an object store, or a local folder in tests) and added with
    ``addPyFile``, from where every executor, including a replacement for a
    lost one, fetches it.
    """
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = f"{scratch_path(spark, 'pyfiles')}/feedlens.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    out = hpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(hpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
