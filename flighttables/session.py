"""Session construction and the shared working folder.

Nothing here changes query semantics: times are kept as ``TIMESTAMP_NTZ`` holding UTC
wall-clock values, so results do not depend on the session time zone.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library is designed for.  AQE coalesces small shuffle
# partitions, splits skewed join partitions and turns joins whose measured build side is
# under ``autoBroadcastJoinThreshold`` into broadcast joins (the size check we rely on
# instead of unconditional ``broadcast()`` hints).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "flighttables",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the recommended settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written intermediate tables, with its URI scheme.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only with a local master, where driver and
    executors are one process, a session that names none gets a fresh local folder, registered so that
    ``DataFrame.checkpoint()`` and our written tables share one root; elsewhere that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a session without a local context (Spark Connect)
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError(NO_SHARED_DIR) from None
        return root.rstrip("/")
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # getCheckpointDir() adds a per-application child folder; its parent is shared.
            root = current.rsplit("/", 1)[0]
    if not root:
        if not is_local(sc.master):
            raise RuntimeError(NO_SHARED_DIR)
        root = tempfile.mkdtemp(prefix="flighttables-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


NO_SHARED_DIR = "set spark.checkpoint.dir to a folder that the driver and all executors share"


def is_local(master: str) -> bool:
    """Whether the master runs everything in one process (``local``, ``local[n]``), unlike ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def new_output_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root for one written table set."""
    return f"{shared_dir(spark)}/flighttables/{name}-{uuid.uuid4().hex[:12]}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on (nothing happens if there is none)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``flighttables`` importable on the executors' Python workers (like ``--py-files``).

    Needed wherever a task runs library Python code.
    The package is zipped once per application and added with ``addPyFile``; Spark's file
    server distributes it to every executor.  The zip is built under the shared folder when
    that is a local path, otherwise in a driver-side folder (an artifact the driver ships,
    like ``--py-files``; no data goes there).
    """
    import hashlib
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: ship as a session artifact instead
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(pkg) for f in fs if f.endswith(".py"))
    digest = hashlib.sha1(b"".join(open(f, "rb").read() for f in files)).hexdigest()[:12]
    root = shared_dir(spark)
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    if "://" in root:
        root = tempfile.gettempdir()
    target = os.path.join(root, "flighttables", f"flighttables-{digest}.zip")
    if not os.path.exists(target):
        os.makedirs(os.path.dirname(target), exist_ok=True)
        tmp = f"{target}.{uuid.uuid4().hex}.part"
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
            for f in files:
                z.write(f, os.path.relpath(f, os.path.dirname(pkg)))
        os.replace(tmp, target)
    if sc is not None:
        sc.addPyFile(target)
    else:
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(app)


# Target bytes per task: large enough to amortise task overhead, small enough that a
# partition's sort / hash buffers fit an executor core's share of memory without heavy spill.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (a distributed listing; no file is read)."""
    from pyspark.sql import functions as F
    total = 0
    for p in paths:
        listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
                   .select("length"))
        total += listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return int(total)


def scale_conf(total_input_bytes: int, target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict:
    """Partition sizing for a job reading ``total_input_bytes``.

    Scan splits and shuffle partitions are sized to ``target_partition_bytes`` (shuffle
    partitions from the input size, which bounds what most jobs here shuffle); AQE then
    coalesces small shuffle partitions towards its advisory size and splits skewed ones
    above five times the median.
    """
    n = max(1, -(-int(total_input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def apply_scale_conf(spark: SparkSession, paths: list[str],
                     target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict:
    """Measure the inputs and set the sizing of :func:`scale_conf` on the session."""
    conf = scale_conf(input_bytes(spark, paths), target_partition_bytes)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
