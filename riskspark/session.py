"""Session construction for tests, the benchmark and local runs.

On a cluster the session comes from the platform; the library only reads
its settings (``spark.checkpoint.dir``) and never overrides them.
"""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession

from .sinks import delete_path


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "riskspark") -> SparkSession:
    """Local session for tests and the benchmark.  It is the only place a
    checkpoint directory (and a warehouse folder) is chosen here: fresh
    scratch folders, unless ``RISKSPARK_CHECKPOINT_DIR`` names one."""
    ckpt = os.environ.get("RISKSPARK_CHECKPOINT_DIR") or tempfile.mkdtemp(
        prefix="riskspark-ckpt-", dir="/tmp")
    # a fresh warehouse per local session: tables made by tests never meet
    # leftovers of an earlier (interrupted) run
    warehouse = tempfile.mkdtemp(prefix="riskspark-warehouse-", dir="/tmp")
    spark = (SparkSession.builder
             .master(f"local[{cpus}]")
             .appName(app_name)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", os.environ.get("RISKSPARK_SESSION_TZ", "UTC"))
             .config("spark.driver.memory", os.environ.get("RISKSPARK_DRIVER_MEMORY", "8g"))
             # Python call-site capture for error messages costs several JVM
             # round trips per Column call while plans are built
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.ansi.enabled", os.environ.get("RISKSPARK_ANSI", "true"))
             .config("spark.checkpoint.dir", ckpt)
             .config("spark.sql.warehouse.dir", warehouse)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings these plans are designed for on a large cluster.  Applied only
# where the platform has not set a value.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # start wide, let AQE merge small partitions to the advisory size
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # split skewed partitions of sort-merge joins (hot units / merchants)
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # broadcast only what AQE measured below this size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # bloom-filter pre-filtering of the large side of selective joins
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_defaults(spark: SparkSession) -> dict[str, str]:
    """Set ``CLUSTER_DEFAULTS`` where the session has no explicit value;
    returns what was set."""
    applied = {}
    for key, value in CLUSTER_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect: no SparkContext here; a server is not this machine
        return False


def _local_part(spark: SparkSession, path: str) -> str | None:
    """The folder on the machine's own file system that ``path`` names; None
    if it is in another store."""
    scheme, _, rest = path.partition(":") if ":" in path.split("/", 1)[0] else ("", "", path)
    if not scheme:
        scheme = (spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file:").split(":", 1)[0]
    return "/" + posixpath.normpath(rest).strip("/") if scheme == "file" else None


def named_folder(spark: SparkSession) -> str | None:
    """The shared folder that the platform has given the session:
    ``spark.checkpoint.dir``, else what ``setCheckpointDir`` was told."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        try:
            named = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: no SparkContext
            pass
    return named


_PROOF_TASKS = 256
_proven: set[tuple[str, str]] = set()


def _rows_seen(spark: SparkSession, path: str, tasks: int) -> int:
    """Rows to be read at ``path`` after ``tasks`` tasks wrote one each."""
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return spark.read.schema("id long").parquet(path).count()
    finally:
        delete_path(spark, path)


def _is_mounted(spark: SparkSession, folder: str) -> bool:
    """Whether the machines share ``folder`` although its path is a local one
    (a mount, or all of them on one machine): what executors write there must
    be there for the driver to commit and for executors to read.  Tried once
    a session, with a row for each core (up to _PROOF_TASKS)."""
    try:
        key = (spark.sparkContext.applicationId, folder)
        tasks = min(max(2, spark.sparkContext.defaultParallelism), _PROOF_TASKS)
    except Exception:  # Spark Connect: nothing is known of the server's machines
        return False
    if key not in _proven:
        if _rows_seen(spark, f"file://{folder}/shared-{uuid.uuid4().hex}", tasks) != tasks:
            return False
        _proven.add(key)
    return True


def shared_path(spark: SparkSession, path: str) -> str:
    """``path`` if all executors can see it: on a cluster a ``file:`` path, or
    one that the default file system resolves to the local disk, is accepted
    only inside the folder that the platform has named, and only if that
    folder turns out to be shared."""
    local = None if _is_local(spark) else _local_part(spark, path)
    if local is not None:
        named = named_folder(spark)
        folder = _local_part(spark, named) if named else None
        if folder is None or not f"{local}/".startswith(f"{folder}/") or not _is_mounted(spark, folder):
            raise RuntimeError(f"{path} is on each machine's own disk; name a folder in shared storage")
    return path.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory (``spark.checkpoint.dir``), which
    on a cluster must be shared storage set by the platform.  Never invents
    one: a job that materialises intermediates fails early without it."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                           "(local_session() sets a scratch folder for tests)")
    shared_path(spark, current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # Spark Connect: no SparkContext; the server applies the setting
        pass
    return current
