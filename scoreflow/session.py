"""Session helpers: building a session for tests and tools, and finding the
shared scratch area every job writes its intermediate tables to.

On a cluster the scratch area is the folder named by ``spark.checkpoint.dir``
(a shared file system such as HDFS or an object store). We only fall back to a
private folder when the setting is absent, which happens in unit tests and
ad-hoc local sessions.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Private folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def build_session(
    master: str | None = "local[8]",
    app_name: str = "scoreflow",
    shuffle_partitions: int | None = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every job in this package assumes. A master or
    partition count of None is left to spark-submit, as the jobs do.

    * AQE on, so shuffle partition counts and skewed sort-merge joins are
      re-planned at run time from the real map output sizes.
    * Session time zone pinned to UTC: all timestamps in the lake are UTC
      wall-clock values.
    * No web UI.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session memos)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared checkpoint folder configured for this session, if any."""
    value = spark.conf.get(CHECKPOINT_KEY, None)
    sc = _context(spark)
    if not value and sc is not None:
        value = sc.getConf().get(CHECKPOINT_KEY, None)
    value = value or _LOCAL_ROOTS.get(app_key(spark))
    if not value and sc is not None:
        value = sc.getCheckpointDir()
    return value or None


def _in_one_process(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Where the session names none, a local
    session (tests, tools) gets a private one; on a cluster, whose executors
    would each write to a disk of their own, that is an error."""
    root = checkpoint_root(spark)
    if root is None:
        if not _in_one_process(spark):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        # The setting itself cannot be changed once the application runs.
        root = _LOCAL_ROOTS[app_key(spark)] = tempfile.mkdtemp(prefix="scoreflow-ckpt-")
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


_JOB_ROOT: ContextVar[str | None] = ContextVar("scoreflow_job_root", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's
    intermediate tables."""
    root = _JOB_ROOT.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/scoreflow"
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """Scratch folders made inside belong to one job and go when it ends, so
    its result must be written or read by then."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scoreflow/job-{uuid.uuid4().hex[:12]}"
    token = _JOB_ROOT.set(root)
    try:
        yield root
    finally:
        _JOB_ROOT.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cluster_settings(
    shuffle_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Starting-point settings for a large cluster.

    * Shuffle partitions: about ``target_partition_bytes`` of the job's largest
      shuffle each, and at least two waves of tasks; AQE then merges small
      ones. These jobs filter or aggregate before they shuffle, so the largest
      shuffle is far below the input: size it from that, not from the input
      (map and reduce tasks multiply in the driver's output tracking).
    * Scan splits of the same target size.
    * Skew join splitting on, with thresholds relative to that size.
    * Broadcast only below 64 MB of estimated size (dimension tables); the
      jobs also check the size of what they broadcast explicitly.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(2 * slots, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
