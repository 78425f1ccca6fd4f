"""Spark session defaults and the shared working folder.

Settings are chosen for a large cluster: AQE re-plans joins and coalesces
partitions at run time, skewed joins are split, and the broadcast threshold is
an explicit size bound. Local runs only lower the shuffle partition count.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on (session time zone pins timestamp rendering).
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only sides that are proven small. The static planner sizes a
    # scan by its compressed files, which understates text-heavy tables, so it
    # keeps the 10 MB default; AQE decides at run time from the measured
    # shuffle output and may broadcast up to 64 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming session windows: merge sessions inside each partition before
    # the shuffle, so a busy key ships partial sessions, not every event
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # stream state off the JVM heap, checkpointed incrementally
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "chanlake") -> SparkSession:
    """Create (or reuse) a session with the cluster defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.master.startswith("local"):
        # on a shared cluster coalesce small post-shuffle partitions toward the
        # advisory size (fewer tiny tasks); locally keep one per core
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Stream state as in the cluster defaults, also in a session made without them: Spark's default store takes no
    operator with timers or several state variables. A stream already checkpointed keeps the store it began with."""
    for key, value in CLUSTER_CONF.items():
        if key.startswith("spark.sql.streaming.stateStore."):
            spark.conf.set(key, value)


def _local_folder(master: str) -> str:
    """A fresh folder for runs on one machine; a cluster has to name a shared one."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="chanlake-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and is used as is;
    without it the call fails. Only a local run (tests) gets a fresh folder. A remote (Connect)
    session has no SparkContext; there the setting is read from the session conf."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no JVM context on this side
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share") from None
        return current
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None) or _local_folder(sc.master)
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path inside the shared checkpoint folder (fresh sub-folder per call)."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    name = os.path.join(*parts) if parts else "work"
    if unique:
        name = f"{name}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + name


def spread(df, min_bytes: int = 4 * 1024 * 1024, max_bytes: int = 1024 * 1024 * 1024):
    """Spread a scan over the cores when its input is far too coarse.

    A file written as one row group is read by one task, however many splits it has, so CPU-heavy work after it runs
    on one core. The scan is redistributed only when that at least quadruples the tasks that hold rows (counted
    without reading a column) and its estimated size lies between ``min_bytes`` and ``max_bytes``: the
    shuffle is bounded, and a larger input, which has more row groups than that, is left alone."""
    target = df.sparkSession.sparkContext.defaultParallelism
    size = estimated_bytes(df)
    if size is None or not min_bytes <= size <= max_bytes:
        return df
    if df.rdd.getNumPartitions() * 4 > target and occupied_tasks(df) * 4 > target:
        return df
    return df.repartition(target)


def occupied_tasks(df) -> int:
    """Tasks of a scan that hold rows; no column is read."""
    from pyspark.sql import functions as F
    return df.select(F.spark_partition_id().alias("p")).groupBy("p").count().count()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started: it is handed to Spark as a zip, once a
    session, unless the environment names its folder already."""
    import zipfile
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    named = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in named or getattr(sc, "_chanlake_shipped", False) or not os.path.isdir(os.path.join(root, "chanlake")):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="chanlake-zip-"), "chanlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "chanlake")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._chanlake_shipped = True


def estimated_bytes(df) -> int | None:
    """Planner estimate of a DataFrame's size (file sizes for scans); None
    when the plan has no statistics (Spark then reports its default size,
    which is a placeholder, not a measurement)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    size = int(size) if isinstance(size, int) else int(size.toString())
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2 ** 63 - 1)))
    return None if size >= unknown else size


def size_shuffle_partitions(spark: SparkSession, input_bytes: int | None,
                            per_partition: int = 256 * 1024 * 1024) -> int:
    """Set ``spark.sql.shuffle.partitions`` so each initial shuffle partition
    holds about ``per_partition`` bytes of input (at least twice the
    cluster's cores). AQE then coalesces the small ones; it cannot split
    large ones (except skewed joins), so the start must be large enough."""
    if input_bytes is None:                       # no estimate: keep the setting
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = 2 * spark.sparkContext.defaultParallelism
    n = max(floor, -(-input_bytes // per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
