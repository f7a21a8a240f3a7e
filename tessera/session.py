"""Session construction and the few session-level facts the library relies on.

Everything here is plain SparkSession configuration. The library itself never
depends on a non-default conf for correctness (ANSI stays on; every cast is a
``try_cast``; out-of-range reads use ``get``), except that the scratch/lineage
folder comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_CHECKPOINT: str | None = None   # private folder, local mode only, when the conf is unset

# SQL defaults the library relies on; applied only where the session does not
# already set them (a cluster's submit-time configuration always wins).
_SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The page pass sends whole HTML documents to Python: bound each Arrow
    # batch by bytes, not only by record count.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}

# Local runs and tests only (set at session creation).
_LOCAL_ONLY = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    # Small local inputs: let AQE keep more, smaller post-shuffle partitions
    # so CPU-heavy decoding after a shuffle uses every core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master``/``shuffle_partitions`` are only for local runs and tests; on a
    cluster leave them ``None`` so the submit-time configuration wins.
    """
    builder = SparkSession.builder.appName(app_name)
    local = bool(master and master.startswith("local"))
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_ONLY) if local else {}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _SQL_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    if local:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage/scratch folder named by ``spark.checkpoint.dir``
    (taken as named: a ``file:`` folder may be a mount that all machines share).

    On a cluster the folder is set by the deployment (a shared filesystem).
    Only when it is unset -- local runs and tests -- a private folder under the
    system temp dir is created and recorded in the session conf.
    """
    global _LOCAL_CHECKPOINT
    path = spark.conf.get(CHECKPOINT_CONF, None) or _LOCAL_CHECKPOINT
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        path = _LOCAL_CHECKPOINT = tempfile.mkdtemp(prefix="tessera-ckpt-")
        try:
            spark.conf.set(CHECKPOINT_CONF, path)
        except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
            pass
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext handle (Spark Connect)
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}"


def materialize(df, name: str, **options):
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return a scan of it: cuts lineage (task retries after an executor loss
    restart from the table, not from the sources) and stops a DataFrame that
    feeds several branches from being recomputed in each."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    # A written table needs its shuffles no more: their files go when the write ends.
    old = spark.conf.get(_CLEANUP_CONF, None)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        df.write.mode("overwrite").options(**options).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP_CONF) if old is None else spark.conf.set(_CLEANUP_CONF, old)
    return spark.read.parquet(path)
