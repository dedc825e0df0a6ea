"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on. UTC because every log time is UTC;
# AQE so join strategy, partition count and skew splits are decided on
# runtime sizes rather than on estimates.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a stream merges session windows before its shuffle
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


# Settings for a large cluster (~100 TB of logs, ~1000 executors); all are
# runtime SQL settings, applied with ``apply_engine_conf(spark, cluster=True)``.
CLUSTER_CONF = {
    # ~256 MB scan splits: 100 TB -> ~400k scan tasks, each well inside memory
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # AQE sizes shuffle partitions from measured bytes; start high, coalesce down
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # session lookups are broadcast only when their measured size is below this
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # a backend or host holding a third of the rows is split by AQE
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    # streaming state (windows x servers x users) off-heap, incremental checkpoints
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_engine_conf(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Set the runtime settings above on an existing session (idempotent).

    ``cluster=True`` adds :data:`CLUSTER_CONF` (set it before the first
    streaming query of a checkpoint: the state store provider and the
    shuffle partition count are fixed per checkpoint).
    """
    conf = dict(ENGINE_CONF, **(CLUSTER_CONF if cluster else {}))
    for k, v in conf.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_spark(master: str | None = None, app: str = "auditlens",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the session is created by the launcher; call
    :func:`apply_engine_conf` on it instead.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    b = b.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    # Python call-site capture for every Column call is a debugging aid;
    # off, plan building on the driver is ~20 % cheaper.
    b = b.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``; only when the session
    names none (local tests) is one made under the system temp folder and
    registered as the session's checkpoint folder.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else "connect"
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="auditlens-")
        if sc is not None:
            sc.setCheckpointDir(base)
            base = sc.getCheckpointDir() or base
        else:
            spark.conf.set("spark.checkpoint.dir", base)
    path = os.path.join(base, "auditlens", name or "t", uuid.uuid4().hex)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, in whatever file system it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the folders ``path``/batch=N whose write has been committed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def remove_matching(spark: SparkSession, pattern: str) -> None:
    """Delete the files that a glob pattern names, in whatever file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.globStatus(at) or []:
        fs.delete(found.getPath(), False)
