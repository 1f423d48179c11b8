"""Session defaults and the shared work folder.

Jobs that write intermediate tables (sinks, ledgers, streaming checkpoints)
put them under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent (local tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from contrail.sources import fs

_MADE: dict[str, list[str]] = {}  # work folders by application

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "contrail",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time and AQE on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # A reused session keeps its settings; the zone is a runtime conf we own.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            base = current
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Unset in local mode, as in unit tests: make our own and register it.
        base = tempfile.mkdtemp(prefix="contrail-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``Dataset.checkpoint()`` has a (shared) folder to write to."""
    base = _shared_base(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def work_dir(spark: SparkSession, name: str, fresh: bool = True) -> str:
    """A folder under the shared checkpoint dir, with its scheme; a new one per call if fresh. Whoever writes creates it."""
    base = fs.resolved(spark, _shared_base(spark))
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if fresh else name
    path = f"{base}/contrail/{leaf}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Delete the work folders this session was given so far; returns how many.

    For when the results that read them have been used: frames made before read nothing afterwards.
    """
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    return sum(fs.delete(spark, path) for path in made)
