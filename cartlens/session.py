"""Session construction and the shared scratch location.

Intermediate tables (checkpoints, stream inputs/outputs, CSV round trips) go
below the directory the cluster names in ``spark.checkpoint.dir``.  Only a
``local`` session without that setting (tests) gets a directory of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "cartlens",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The reliable checkpoint directory of the session: the one already set
    on the context or given as ``spark.checkpoint.dir``.

    Without either, a session on this one machine (``local`` master: tests,
    laptops) gets a new temporary directory; on a cluster, where every executor
    would write to its own disk, that is an error."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None:
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a directory that all executors share")
        configured = tempfile.mkdtemp(prefix="cartlens-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_id(spark: SparkSession) -> str:
    """Identifies the running application (results are cached per application)."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint root for an intermediate table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/cartlens/{name}-{uuid.uuid4().hex[:12]}"
