"""Session setup and shared-storage locations.

Every operator in this package is a plain DataFrame function; the only
session-level assumptions are a UTC session time zone (event times are
zone-less wall clock) and a shared folder for lineage cuts, streaming
checkpoints and scratch tables.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_TIME_ZONE = "UTC"
# Large streaming state: off-heap RocksDB, changelog checkpoints.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "rill",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    rocksdb_state: bool = False,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect.

    ``master`` is only set when given, so a cluster submit keeps its own.
    On a cluster set ``shuffle_partitions`` to roughly shuffle bytes /
    128 MiB (it also fixes the number of state-store partitions of a new
    streaming checkpoint). ``rocksdb_state`` keeps streaming state in
    RocksDB instead of executor heap, for large key x window state.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": SESSION_TIME_ZONE,
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # remove reliable checkpoints (lineage cuts) once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # no-data micro-batches let the watermark close the last windows
        "spark.sql.streaming.noDataMicroBatches.enabled": "true",
    }
    if rocksdb_state:
        settings.update(ROCKSDB_STATE)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    conform(spark)
    return spark


def rocksdb_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same tables and context) whose streams keep their state in RocksDB."""
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.ansi.enabled"):
        session.conf.set(key, spark.conf.get(key))
    for key, value in ROCKSDB_STATE.items():
        session.conf.set(key, value)
    return conform(session)


# Far below the default, which is several hundred times the size of a minute partition's file.
SMALL_FILE_OPEN_COST = "64k"
LISTING_TASKS = 64


def small_files_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same tables, context and settings) that reads many small files with few tasks.

    Files are packed into tasks by their size, and folders are listed by a few
    tasks a core and not by one each. Large files are split as ever.
    """
    session = spark.newSession()
    tasks = max(LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism)
    settings = {
        **spark.conf.getAll,
        "spark.sql.files.openCostInBytes": SMALL_FILE_OPEN_COST,
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks),
    }
    for key, value in settings.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    return conform(session)


def conform(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on (idempotent).

    Epoch conversions and LTZ<->NTZ casts are done in the session time zone.
    Strict checks raise by themselves, whatever the ANSI setting is.
    Everything else is left to the caller.
    """
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    shared_dir(spark)
    return spark


def let_workers_import(spark: SparkSession) -> None:
    """Python workers of a local session find this package wherever the driver was started.

    On a cluster the package is installed or sent with ``--py-files``.
    """
    context, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if _is_local(spark):
        known = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in known:
            context.environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only a local session without one gets a fresh
    private folder; a cluster session without one is an error, because a
    machine-local folder is invisible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running streaming or replay jobs"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rill-shared-"))
    return sc.getCheckpointDir().rstrip("/")


def durable_dir(spark: SparkSession) -> str:
    """Where streaming checkpoints of jobs live, the same in every session.

    Directly under the configured ``spark.checkpoint.dir``. A local session
    without one uses its warehouse folder, where its tables live too.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return f"{configured.rstrip('/')}/rill/checkpoints"
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) so that jobs resume after a restart"
        )
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_rill_checkpoints"


def job_checkpoint(spark: SparkSession, job: str, sink: str) -> str:
    """The default checkpoint of a job: a function of job and sink name."""
    readable = re.sub(r"[^A-Za-z0-9]+", "-", sink).strip("-")[-40:]
    digest = hashlib.sha256(sink.encode()).hexdigest()[:10]
    return f"{durable_dir(spark)}/{job}/{readable}-{digest}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique location under the shared folder."""
    return f"{shared_dir(spark)}/rill/{label}-{uuid.uuid4().hex[:12]}"
