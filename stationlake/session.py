"""Spark session set-up shared by the library, the tests and the bench.

The library never creates a session on its own; callers pass one in.  What the
model needs from a session is small: UTC as the session time zone (a
measurement day is the UTC day of its period), ANSI casts (a malformed number
fails loudly, as a typed load would) and AQE for runtime re-planning.  Writes
that replace only some partitions say so per write, so a caller's session
keeps its own overwrite mode.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every query in this package relies on.  They are session-scoped SQL
# confs, so they can be applied to a session someone else built.
MODEL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimensions are broadcast by their size in bytes, estimated or met at run time.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


# Sizing for a large cluster (set at submit time; not applied automatically).
# Shuffle partitions start high and AQE coalesces them towards the advisory
# size, so a 100 TB stage gets ~128 MB partitions that fit executor memory and
# a small stage is not split into thousands of tasks.  Skew-join splitting is
# on for partitions 5x larger than the median and above 256 MB.  Input splits
# are 256 MB.
CLUSTER_SIZING = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
}


def apply_model_conf(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings the model depends on."""
    for key, value in MODEL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "stationlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session builder for local runs, tests and the bench.

    On a cluster the master and resources come from spark-submit; only the
    model settings are added here.  The Spark UI stays off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(MODEL_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_model_conf(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables and checkpoints that every executor can see.

    The cluster names it in ``spark.checkpoint.dir``; that setting wins.  Only
    in local mode with nothing configured (local runs and tests) is a fresh
    folder under the system temp dir created and registered; on a cluster a
    missing setting is an error, never a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the conf is all there is
        sc = None
    if not configured and sc is not None:
        configured = sc.getCheckpointDir()
    if not configured:
        master = spark.conf.get("spark.master", "") or ""
        if not re.match(r"local(\[|$)", master):  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can "
                "reach (it holds written tables, checkpoints and stream state)"
            )
        configured = tempfile.mkdtemp(prefix="stationlake-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(configured)
        else:
            spark.conf.set("spark.checkpoint.dir", configured)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-application memos)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent jobs at the same time; the first error is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [job.result() for job in jobs]
